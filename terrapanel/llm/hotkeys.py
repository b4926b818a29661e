"""Left joins with one row for each key, where a few keys may hold most of the rows.

A key that holds at least one row in ``HEAVY`` is answered by a broadcast: there are no more than ``HEAVY`` of
them, whatever the size of the tables, since their rows add up to no more than all rows.  The others meet their
answers in a shuffle in which no key has a larger share than that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAVY = 10_000


def _same(rows: DataFrame, answers: DataFrame, on: str) -> Column:
    return rows[on].eqNullSafe(answers["asked_key"])


def look_up(rows: DataFrame, answers: DataFrame, on: str, total: int, size: str) -> DataFrame:
    """Each row of ``rows`` with the columns of the row of ``answers`` for its key (nulls are equal), null if there is none.

    ``answers`` has each key of its column ``on`` once, with the number of rows that have it in ``size``; ``total`` is
    the number of rows.  Both tables are read twice, so they should be written tables.
    """
    answers = answers.withColumnRenamed(on, "asked_key")
    heavy = answers.where(F.col(size) * HEAVY >= total)
    light = answers.where(F.col(size) * HEAVY < total)
    often = rows.join(F.broadcast(heavy), _same(rows, heavy, on)).drop("asked_key")
    rest = rows.join(F.broadcast(heavy.select("asked_key")), _same(rows, heavy, on), "left_anti")
    return often.unionByName(rest.join(light, _same(rest, light, on), "left").drop("asked_key"))


def counted(rows: DataFrame, answers: DataFrame, on: str) -> DataFrame:
    """:func:`look_up` where the numbers of rows are not known yet; broadcasts ``answers`` where it has ``HEAVY`` rows at most."""
    if answers.count() <= HEAVY:
        few = answers.withColumnRenamed(on, "asked_key")
        return rows.join(F.broadcast(few), _same(rows, few, on), "left").drop("asked_key")
    sizes = rows.groupBy(F.col(on).alias("size_of")).agg(F.count("*").alias("key_rows"))
    sized = answers.join(sizes, answers[on].eqNullSafe(sizes["size_of"])).drop("size_of")
    return look_up(rows, sized, on, rows.count(), "key_rows").drop("key_rows")
