"""Social-network questions over people, a directed friend edge list and an
access log (SURVEY §2A, Q01–Q13).

Every function takes DataFrames and returns a lazy DataFrame.  Column names
default to the library schemas (``murmuration.schemas``) and are parameters
where a binding needs other tables.  Notes on the physical plan are given per
operator: which shuffles it needs, what is pre-aggregated, and which sides may
be broadcast (only sides whose row count is bounded by construction).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmuration.functions import norm_text, trimmed, typed_like, whole_days_between
from murmuration.functions.exprs import BLANKS

UNKNOWN_NAME = "Unknown"


# --------------------------------------------------------------------- Q01
def users_by_nationality(people: DataFrame, nationality: str,
                         case_sensitive: bool = False,
                         nationality_col: str = "nationality",
                         out_cols: Sequence[str] = ("name", "hobby")) -> DataFrame:
    """People of one nationality (Q01): a filter + projection, no shuffle.

    The default match trims (every character up to U+0020) and case-folds both
    sides; ``case_sensitive=True`` is an exact comparison, which parquet sources
    also push into the scan.  Text of the result is trimmed.
    """
    c = F.col(nationality_col)
    if case_sensitive:
        cond = c == F.lit(nationality)
    else:
        cond = norm_text(c) == F.lower(F.lit(nationality.strip(BLANKS)))
    kinds = dict(people.dtypes)
    return people.filter(cond).select(
        *[trimmed(k).alias(k) if kinds[k] == "string" else k for k in out_cols])


# --------------------------------------------------------------------- Q02
def top_pages(access: DataFrame, owners: DataFrame, n: int = 10,
              page_col: str = "what_page", owner_key: str = "person_id",
              owner_cols: Sequence[str] = ("name", "nationality", "hobby"),
              dedupe_owners: bool = False) -> DataFrame:
    """The n most accessed pages with their owners' details (Q02).

    Counted per page first (partial + final aggregate), cut to n with the
    fixed order ``count DESC, page ASC`` (planned as TakeOrderedAndProject:
    each task keeps n rows, no global sort), then joined to the owners; the
    planner knows the cut's size and picks the join.  ``dedupe_owners`` keeps
    one owner row per page, the smallest by its columns, after the join, so the
    owner table is not aggregated.
    A page without an owner drops out after the cut, so fewer than n rows may
    return.
    """
    if n < 0:
        raise ValueError("n must be >= 0")
    counts = (access.groupBy(F.col(page_col).alias("page_id"))
              .agg(F.count(F.lit(1)).alias("access_count")))
    top = counts.orderBy(F.desc("access_count"), F.asc("page_id")).limit(n)
    # rank among the <= n rows kept (bounded window input)
    ranked = top.withColumn(
        "page_rank",
        F.row_number().over(Window.orderBy(F.desc("access_count"), F.asc("page_id")))
        .cast(T.LongType()))
    own = owners.select(F.col(owner_key).alias("page_id"), *owner_cols)
    out = own.join(ranked, "page_id", "inner")
    if dedupe_owners:
        out = (out.groupBy("page_id", "access_count", "page_rank")
               .agg(F.min(F.struct(*owner_cols)).alias("_o"))
               .select("page_id", "access_count", "page_rank",
                       *[F.col("_o").getField(c).alias(c) for c in owner_cols]))
    return (out.select("page_id", *owner_cols, "access_count", "page_rank"))


# --------------------------------------------------------------------- Q03
def count_by_country(people: DataFrame, nationality_col: str = "nationality") -> DataFrame:
    """People per trimmed nationality (Q03); empty and null values form their own groups."""
    return (people.groupBy(trimmed(nationality_col).alias("nationality"))
            .agg(F.count(F.lit(1)).alias("n_people")))


# --------------------------------------------------------------------- Q04
def friend_counts_outdegree(people: DataFrame, friends: DataFrame) -> DataFrame:
    """Rows each person lists as their friends (out-degree), Q04.

    Full outer join of people with the per-owner counts: people without a
    row get 0, owners missing from people get the name ``Unknown``.  The
    counts are pre-aggregated before the join (partial aggregate), so a hub
    owner ships one row per map task, not one per edge.
    """
    deg = (friends.groupBy(F.col("person_id").alias("src"))
           .agg(F.count(F.lit(1)).alias("friend_count")))
    p = people.select(F.col("person_id").alias("pid"), "name")
    j = p.join(deg, p.pid == deg.src, "full_outer")
    return j.select(F.coalesce("pid", "src").alias("person_id"),
                    F.coalesce(F.col("name"), F.lit(UNKNOWN_NAME)).alias("name"),
                    F.coalesce(F.col("friend_count"), F.lit(0).cast(T.LongType())).alias("friend_count"))


# --------------------------------------------------------------------- Q05
def friend_counts_indegree(people: DataFrame, friends: DataFrame) -> DataFrame:
    """How often each person is listed by others (in-degree), Q05; left outer,
    default 0."""
    deg = (friends.groupBy(F.col("friend_id").alias("pid"))
           .agg(F.count(F.lit(1)).alias("friend_count")))
    p = people.select(F.col("person_id").alias("pid"), "name")
    return (p.join(deg, "pid", "left")
            .select(F.col("pid").alias("person_id"), "name",
                    F.coalesce(F.col("friend_count"), F.lit(0).cast(T.LongType())).alias("friend_count")))


# --------------------------------------------------------------------- Q06
def access_profile(access: DataFrame) -> DataFrame:
    """Per visitor: total accesses and distinct pages accessed (Q06).

    Written as two aggregates: first per (visitor, page) — which collapses
    repeat visits map-side — then per visitor.  No per-group set is ever
    held, so a visitor with a third of all rows costs no more memory than
    any other.
    """
    pairs = (access.groupBy(F.col("by_who").alias("person_id"), F.col("what_page"))
             .agg(F.count(F.lit(1)).alias("n")))
    return (pairs.groupBy("person_id")
            .agg(F.sum("n").cast(T.LongType()).alias("total_accesses"),
                 F.count("what_page").alias("distinct_pages")))


# --------------------------------------------------------------------- Q07
def friend_visit_counts(friends: DataFrame, access: DataFrame) -> DataFrame:
    """Per owner: distinct friends and how many of them the owner visited.

    Edges and visits are tagged and unioned, then aggregated once per
    (src, dst) — partial aggregation collapses repeats map-side — and once
    per owner.  Two shuffles, no join (so no sort of either side), and a hub
    owner is spread over the (src, dst) partitions until the per-owner
    count, which ships one partial row per task.  A pair with a null key is
    never a visit (as in an equi-join).
    """
    e = friends.select(F.col("person_id").alias("src"), F.col("friend_id").alias("dst"),
                       F.lit(1).alias("is_edge"), F.lit(0).alias("is_visit"))
    v = access.select(F.col("by_who").alias("src"), F.col("what_page").alias("dst"),
                      F.lit(0).alias("is_edge"), F.lit(1).alias("is_visit"))
    keyed = F.col("src").isNotNull() & F.col("dst").isNotNull()
    pairs = (e.unionByName(v).groupBy("src", "dst")
             .agg(F.max("is_edge").alias("edge"),
                  F.max(F.when(keyed, F.col("is_visit"))).alias("visit")))
    return (pairs.filter(F.col("edge") == 1).groupBy("src")
            .agg(F.count(F.lit(1)).alias("n_friends"),
                 F.count(F.when(F.col("visit") == 1, F.lit(1))).alias("n_visited")))


def neglectful_all(people: DataFrame, friends: DataFrame, access: DataFrame) -> DataFrame:
    """People with at least one friend who visited none of them (Q07).

    Owners whose visited-friend count is 0 (``friend_visit_counts``); names
    come from a left join (``Unknown`` when the owner is not in people).
    """
    neglect = friend_visit_counts(friends, access).filter(F.col("n_visited") == 0).select("src")
    p = people.select(F.col("person_id").alias("src"), "name")
    return (neglect.join(p, "src", "left")
            .select(F.col("src").alias("person_id"),
                    F.coalesce(F.col("name"), F.lit(UNKNOWN_NAME)).alias("name")))


# --------------------------------------------------------------------- Q08
def neglectful_any(people: DataFrame, friends: DataFrame, access: DataFrame) -> DataFrame:
    """People with at least one friend they never visited (Q08); only people
    with a name, each once: owners with fewer visited friends than friends."""
    unvisited = (friend_visit_counts(friends, access)
                 .filter(F.col("n_visited") < F.col("n_friends")).select("src"))
    p = people.select(F.col("person_id").alias("src"), "name")
    return (unvisited.join(p, "src", "inner")
            .select(F.col("src").alias("person_id"), "name").distinct())


# --------------------------------------------------------------------- Q09–Q11
def _cutoff(access: DataFrame, as_of, days: int, time_col: str = "access_time") -> Column:
    as_of_c = typed_like(as_of, access.schema[time_col].dataType)
    return as_of_c - F.make_interval(days=F.lit(int(days)))


def _as_of(access: DataFrame, as_of, time_col: str = "access_time") -> Column:
    return typed_like(as_of, access.schema[time_col].dataType)


def readable_times(access: DataFrame, time_col: str = "access_time",
                   pattern: str = "yyyy-MM-dd HH:mm:ss", strict: bool = False) -> DataFrame:
    """Accesses whose text time parses; the others are skipped, row by row.

    ``strict``: a time that does not parse fails the job, naming the value (a
    null time is skipped all the same).
    """
    text = F.col(time_col)
    at = F.try_to_timestamp(text, F.lit(pattern)).cast("timestamp_ntz")
    if strict:
        refused = F.raise_error(F.concat(F.lit("not a time: "), text)).cast("timestamp_ntz")
        at = F.when(text.isNotNull() & at.isNull(), refused).otherwise(at)
    return access.withColumn(time_col, at).filter(F.col(time_col).isNotNull())


def trimmed_ids(df: DataFrame, *columns: str) -> DataFrame:
    """Text ids without blanks around them, as joins on them need; an id of
    blanks only is no id (null)."""
    return df.withColumns({c: F.nullif(trimmed(c), F.lit("")) for c in columns})


def _latest(access: DataFrame) -> DataFrame:
    return (access.groupBy(F.col("by_who").alias("person_id"))
            .agg(F.max("access_time").alias("latest_access")))


def disconnected(people: DataFrame, access: DataFrame, as_of, days: int = 14) -> DataFrame:
    """People whose latest access is before ``as_of - days`` or who never
    accessed (Q09).  ``as_of`` is a literal or a scalar Column (e.g. a scalar
    subquery); the reference's wall-clock "now" is made explicit."""
    cutoff = _cutoff(access, as_of, days)
    p = people.select("person_id", "name")
    j = p.join(_latest(access), "person_id", "left")
    return (j.filter(F.col("latest_access").isNull() | (F.col("latest_access") < cutoff))
            .filter(F.col("name").isNotNull())
            .select("person_id", "name"))


def disconnected_known(people: DataFrame, access: DataFrame, as_of, days: int = 14) -> DataFrame:
    """As Q09 over people with at least one access, by whole 24-hour days
    elapsed since the latest access ``>= days`` (Q10)."""
    stale = _latest(access).filter(
        whole_days_between(F.col("latest_access"), _as_of(access, as_of)) >= F.lit(int(days)))
    p = people.select("person_id", "name")
    return stale.join(p, "person_id", "inner").select("person_id", "name")


def disconnected_antijoin(people: DataFrame, access: DataFrame, as_of, days: int = 14) -> DataFrame:
    """People with no access strictly after ``as_of - days`` (Q11).

    One filtered scan (the time predicate reaches the parquet reader) gives
    the recently active visitors; an anti join removes them from people.  No
    max is needed.  The active set grows with users, so the planner chooses
    between broadcast and shuffled anti join from its measured size.
    """
    cutoff = _cutoff(access, as_of, days)
    active = (access.filter(F.col("access_time") > cutoff)
              .select(F.col("by_who").alias("person_id")).distinct())
    return (people.select("person_id", "name")
            .join(active, "person_id", "left_anti"))


# --------------------------------------------------------------------- Q12
def popular_people(people: DataFrame, friends: DataFrame, node_key: str = "person_id",
                   name_col: str = "name", dst_col: str = "friend_id") -> DataFrame:
    """People listed more often than average (Q12): in-degree strictly above
    (all edges ÷ all people), with name and count.

    The two global counts run as uncorrelated scalar subqueries (computed
    once, one row each).  The edge count is the sum of the per-person counts
    (edges without a target included), so the edges are read once.
    """
    deg = (friends.groupBy(F.col(dst_col).alias("person_id"))
           .agg(F.count(F.lit(1)).alias("friend_count")))
    n_edges = deg.select(F.sum("friend_count").cast(T.DoubleType())).scalar()
    n_people = people.select(F.count(F.lit(1)).cast(T.DoubleType())).scalar()
    avg = F.coalesce(F.try_divide(n_edges, n_people), F.lit(0.0))
    popular = deg.filter(F.col("friend_count") > avg)
    p = people.select(F.col(node_key).alias("person_id"), F.col(name_col).alias("name"))
    return (popular.join(p, "person_id", "inner")
            .filter(F.col("name").isNotNull())
            .select("person_id", "name", "friend_count"))


# --------------------------------------------------------------------- Q13
def popular_people_linked(people: DataFrame, friends: DataFrame) -> DataFrame:
    """People whose out-degree is strictly above the mean out-degree of the
    people having at least one edge (Q13); id and name, each once."""
    # owners without an id are no people; filtered before the aggregate, so the
    # join and the mean share one exchange
    deg = (friends.filter(F.col("person_id").isNotNull()).groupBy("person_id")
           .agg(F.count(F.lit(1)).alias("num_friends")))
    stats = deg.select(F.try_divide(F.sum("num_friends").cast(T.DoubleType()),
                                    F.count(F.lit(1)).cast(T.DoubleType())).alias("avg")).scalar()
    popular = deg.filter(F.col("num_friends") > stats).select("person_id")
    p = people.select("person_id", "name")
    return popular.join(p, "person_id", "inner").select("person_id", "name").distinct()
