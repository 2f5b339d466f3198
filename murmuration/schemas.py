"""Fixed schemas of the social tables and the point sets.

The files' own header names are kept in ``*_FILE_COLUMNS``; the library's
column names are those of the ``*_SCHEMA`` StructTypes.
"""

from pyspark.sql import types as T

PEOPLE_SCHEMA = T.StructType([
    T.StructField("person_id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("nationality", T.StringType()),
    T.StructField("country_code", T.IntegerType()),
    T.StructField("hobby", T.StringType()),
])

FRIENDS_SCHEMA = T.StructType([
    T.StructField("rel_id", T.LongType()),
    T.StructField("person_id", T.LongType()),
    T.StructField("friend_id", T.LongType()),
    T.StructField("since", T.DateType()),
    T.StructField("relation", T.StringType()),
])

ACCESS_SCHEMA = T.StructType([
    T.StructField("access_id", T.LongType()),
    T.StructField("by_who", T.LongType()),
    T.StructField("what_page", T.LongType()),
    T.StructField("access_type", T.StringType()),
    # Text "yyyy-MM-dd HH:mm:ss" without a zone: a wall-clock timestamp.
    T.StructField("access_time", T.TimestampNTZType()),
])

POINTS_SCHEMA = T.StructType([
    T.StructField("x", T.LongType()),
    T.StructField("y", T.LongType()),
])

# Header names of the reference's CSV files, in file order.
PEOPLE_FILE_COLUMNS = ["PersonID", "Name", "Nationality", "Country Code", "Hobby"]
FRIENDS_FILE_COLUMNS = ["FriendRel", "PersonID", "MyFriend", "DateOfFriendship", "Desc"]
ACCESS_FILE_COLUMNS = ["AccessID", "ByWho", "WhatPage", "TypeOfAccess", "AccessTime"]
POINTS_FILE_COLUMNS = ["x", "y"]
