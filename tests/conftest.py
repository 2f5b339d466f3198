from __future__ import annotations

import os
import sys
import tempfile

# before numpy is loaded: its threads may not mix with the forks of a Spark session
os.environ.setdefault("OPENBLAS_NUM_THREADS", "1")

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TESTDATA = "/root/testdata"

# A hand-made network: 6 people, 10 edges (one twice, one to and one from a
# stranger), 9 accesses.
SOCIAL_FILES = {
    "pages.csv": [
        "PersonID,Name,Nationality,Country Code,Hobby",
        "0,Ada,France,33,Chess", "1,Bo, Peru,51,Go", "2,Cy,Peru ,51,Tea",
        "3,Di,Mali,223,Chess", "4,Ed,Mali,223,Tea", "5,Flo,Peru,51,Go"],
    "friends.csv": [
        "FriendRel,PersonID,MyFriend,DateOfFriendship,Desc",
        "0,0,1,2020-01-01,a", "1,0,2,2020-01-02,a", "2,0,1,2020-01-03,again", "3,1,0,2020-01-01,b",
        "4,2,0,2020-01-01,c", "5,2,3,2020-01-01,c", "6,3,0,2020-01-01,d", "7,3,9,2020-01-01,d",
        "8,9,0,2020-01-01,stranger", "9,4,2,2020-01-01,e"],
    "access_logs.csv": [
        "AccessID,ByWho,WhatPage,TypeOfAccess,AccessTime",
        "0,0,1,View,2024-06-10 00:00:00", "1,0,2,View,2024-06-01 00:00:00",
        "2,0,1,Edit,2024-06-02 00:00:00", "3,1,2,View,2024-06-07 00:00:00",
        "4,2,0,View,2024-06-06 23:59:59", "5,2,1,View,2024-01-01 00:00:00",
        "6,3,4,View,2024-06-20 00:00:00", "7,4,2,View,2024-05-01 12:00:00",
        "8,9,2,View,2024-06-20 00:00:00"],
}


def grid_points(n: int = 3000) -> list[tuple[int, int]]:
    """Points spread over 0..5000 by a rule, a few of them twice."""
    return [((i % (n - 5)) * 7919 % 5001, (i % (n - 5)) ** 2 * 31 % 4999) for i in range(n)]


@pytest.fixture(scope="session")
def spark():
    from murmuration.session import build_session
    s = build_session("local[4]", app_name="murmuration-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="murmuration-test-")


@pytest.fixture(scope="session")
def data_dir():
    """A folder with the hand-made network, points and start centers as CSV files."""
    from murmuration.sources.bindings import START_CENTERS
    folder = tempfile.mkdtemp(prefix="murmuration-data-")
    files = dict(SOCIAL_FILES)
    files["points.csv"] = ["x,y", *(f"{x},{y}" for x, y in grid_points())]
    files["centers.txt"] = [f"{x},{y}" for x, y in START_CENTERS]
    for name, lines in files.items():
        with open(os.path.join(folder, name), "w") as f:
            f.write("\n".join(lines) + "\n")
    return folder


@pytest.fixture(scope="session")
def social_tables(spark, data_dir):
    from murmuration.sources import read_access, read_friends, read_people
    return {
        "people": read_people(spark, os.path.join(data_dir, "pages.csv")),
        "friends": read_friends(spark, os.path.join(data_dir, "friends.csv")),
        "access": read_access(spark, os.path.join(data_dir, "access_logs.csv")),
    }


def sf_dir(sf: str) -> str:
    p = os.path.join(TESTDATA, f"sf{sf}")
    if not os.path.isdir(p):
        pytest.skip(f"{p} not available")
    return p
