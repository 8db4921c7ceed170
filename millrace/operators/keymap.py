"""One dimension out of several sources whose business keys may be the same.

A key map holds a surrogate key for every (source, business key); it only ever
grows, so a member keeps its key from load to load.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.keys import append_members, new_members
from millrace.operators.quality import require_constraints

VERSIONS, SHARED = "Versions", "SharedBy"


def resolve(staged: DataFrame, source: str, business_key: str, newest: Column) -> DataFrame:
    """One row per (source, business key): the one with the greatest ``newest``; VERSIONS counts how many differ.

    Rows equally new are decided by their attributes, so the result does not depend
    on the order of arrival. Partial results are made before the shuffle: a member
    repeated very often is one row per task in it. A row without source or key raises.
    """
    require_constraints(staged, [source, business_key], {}, "staged rows")
    attributes = [c for c in staged.columns if c not in (source, business_key)]
    state = F.struct(*attributes)
    found = staged.groupBy(source, business_key).agg(
        F.max_by(state, F.struct(newest, state)).alias("_state"), F.count_distinct(state).alias(VERSIONS)
    )
    return found.select(source, business_key, "_state.*", VERSIONS)


def extended_map(key_map: DataFrame, members: DataFrame, source: str, business_key: str, key: str) -> DataFrame:
    """The key map (key, source, business key) with the pairs it does not hold yet, numbered after its keys."""
    pair = [source, business_key]
    fresh = new_members(members.select(*pair).distinct(), key_map, pair)
    return key_map.unionByName(append_members(key_map, fresh, pair, key))


def sharing(key_map: DataFrame, source: str, business_key: str) -> DataFrame:
    """(business key, SHARED): in how many sources each business key is used."""
    return key_map.groupBy(business_key).agg(F.count_distinct(source).alias(SHARED))


def integrated(key_map: DataFrame, members: DataFrame, source: str, business_key: str) -> DataFrame:
    """Resolved members with their surrogate keys, VERSIONS and SHARED: the dimension and its report in one."""
    keyed = members.join(key_map, [source, business_key])
    return keyed.join(sharing(key_map, source, business_key), business_key)


def conflicts(dimension: DataFrame) -> DataFrame:
    """The members a load should report: rows that contradict each other, or a key that several sources use."""
    return dimension.where((F.col(VERSIONS) > 1) | (F.col(SHARED) > 1))
