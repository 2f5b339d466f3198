"""The command line over a small hand-made folder, answers worked out by hand."""

from __future__ import annotations

import glob
import os

import pytest

from murmuration.cli import run

TABLES = {
    "pages.csv": ["PersonID,Name,Nationality,Country Code,Hobby",
                  "1,Ada,France,33,Chess", "2,Bo,\t France ,33,Go", "3,Cy,Peru,51,Chess",
                  "4,Di,Peru,51,Tea"],
    "friends.csv": ["FriendRel,PersonID,MyFriend,DateOfFriendship,Desc",
                    "0,1,2,2020-01-01,a", "1,1,3,2020-01-01,b", "2,2,1,2020-01-01,c",
                    "3,3,4,2020-01-01,d"],
    "access_logs.csv": ["AccessID,ByWho,WhatPage,TypeOfAccess,AccessTime",
                        "0,1,2,Viewed,2024-06-20 10:00:00", "1,2,1,Viewed,2024-01-01 10:00:00",
                        "2,2,1,Viewed,2024-06-01 10:00:00", "3,3,1,Viewed,2024-06-19 10:00:00"],
    "points.csv": ["x,y", "0,0", "0,2", "10,10", "10,12"],
    "start.txt": ["0,0", "10,10"],
}


@pytest.fixture()
def folder(tmp_dir):
    for name, lines in TABLES.items():
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write("\n".join(lines) + "\n")
    return tmp_dir


def _rows(out):
    rows = []
    for path in sorted(glob.glob(os.path.join(out, "part-*.csv"))):
        with open(path) as f:
            rows += [line.split(",") for line in f.read().splitlines()[1:]]
    return sorted(rows)


def _task(folder, task, *extra):
    out = os.path.join(folder, "out")
    assert run([task, "--input", folder, "--output", out, *extra]) == 0
    return _rows(out)


def test_nationality_ignores_padding(spark, folder):
    got = _task(folder, "users-by-nationality", "--nationality", "france")
    assert got == [["Ada", "Chess"], ["Bo", "Go"]]


def test_countries(spark, folder):
    assert _task(folder, "count-by-country") == [["France", "2"], ["Peru", "2"]]


def test_top_page(spark, folder):
    got = _task(folder, "top-pages", "--n", "1")
    assert len(got) == 1 and {"1", "Ada"} <= set(got[0])


def test_neglectful(spark, folder):
    got = _task(folder, "neglectful-all")
    assert len(got) == 1 and {"3", "Cy"} <= set(got[0])


def test_disconnected(spark, folder):
    got = _task(folder, "disconnected", "--as-of", "2024-06-21 00:00:00")
    assert [r[:2] for r in got] == [["2", "Bo"], ["4", "Di"]]


def test_kmeans(spark, folder):
    out = os.path.join(folder, "k")
    assert run(["kmeans", "--input", folder, "--output", out, "--r", "20", "--check",
                "--centers", os.path.join(folder, "start.txt")]) == 0
    centers = _rows(os.path.join(out, "centers"))
    assert len(centers) == 2 and all("true" in c for c in centers)
    assert [c[1:3] for c in centers] == [["0", "1"], ["10", "11"]]
    assert len(_rows(os.path.join(out, "clustered"))) == 4


def test_explain_writes_nothing(spark, folder):
    out = os.path.join(folder, "never")
    assert run(["top-pages", "--input", folder, "--output", out, "--explain"]) == 0
    assert not os.path.exists(out)
