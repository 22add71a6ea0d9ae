"""Rows that share table keys, and groups of rows whose members are compared in blocks.

Both near-dup operators give every row some table keys and must test the pairs that share
one. A key's rows each form a pair with its first row only, so a key that very many rows share
gives as many pairs, not their square. Within a group of rows, two blocks at a time are compared
in one task, and only what follows for the rows leaves it, no pairs. The rows of a key that are
in different components are compared as blocks too, and their near pairs leave the task.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from sheen.llm.common import frozen


def star_rows(rows: DataFrame, partitions: int) -> DataFrame:
    """(key, rid) to (key, rid, centre): each row of a key but the first, with the first. Keys
    are read as a sorted stream, so a key that very many rows share needs no memory."""
    def run(batches):
        last = None
        for batch in batches:
            key, rid = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            if not len(key):
                continue
            if last is not None:
                key, rid = np.append(last[0], key), np.append(last[1], rid)
            first = np.concatenate(([True], key[1:] != key[:-1]))
            centre = rid[np.flatnonzero(first)][np.cumsum(first) - 1]
            rest = ~first
            last = key[-1], centre[-1]
            yield pa.RecordBatch.from_pydict({"key": pa.array(key[rest]), "rid": pa.array(rid[rest]),
                                              "centre": pa.array(centre[rest])})

    return (rows.repartition(partitions, "key").sortWithinPartitions("key", "rid")
            .mapInArrow(run, "key long, rid long, centre long"))


def star_pairs(stars: DataFrame) -> DataFrame:
    return stars.select(F.col("rid").alias("a"), F.col("centre").alias("b")).distinct()


def whole_groups(batches, columns: Callable):
    """Arrays of a stream sorted by its first column, cut between its values.
    ``columns(batch)`` gives the arrays of a batch."""
    held = None
    for batch in batches:
        if not len(batch):
            continue
        x = columns(batch)
        if held is not None:
            x = [np.concatenate((h, v)) for h, v in zip(held, x)]
        last = int(np.searchsorted(x[0], x[0][-1], "left"))
        if last:
            yield [v[:last] for v in x]
        held = [v[last:] for v in x]
    if held is not None:
        yield held


def group_ranges(key: np.ndarray):
    cut = (np.flatnonzero(np.diff(key)) + 1).tolist()
    return zip([0, *cut], [*cut, len(key)])


def dealt_across(members: DataFrame, block: int) -> DataFrame:
    """(group, key, p, q, block, rid, comp) of keys' rows (key, rid, comp): the rows of each key
    that holds several components are dealt over blocks of about ``block`` rows, and a row goes
    to each pair (p, q) of its block and another of its key. A component with at least ``block``
    rows of a key has blocks of its own there, which are not paired with each other; the rest of
    the key shares blocks, each paired with itself too. So a key that very many rows share is
    dealt over many tasks, and rows of one large component are not compared among themselves."""
    sizes = members.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("m"))
    big = F.col("m") >= block
    keys = sizes.groupBy("key").agg(
        F.count(F.lit(1)).alias("comps"),
        F.ceil(F.coalesce(F.sum(F.when(~big, F.col("m"))), F.lit(0)) / block).cast("long").alias("shared"),
        F.coalesce(F.sum(F.when(big, F.ceil(F.col("m") / block))), F.lit(0)).cast("long").alias("whole"),
    ).where("comps > 1").select("key", "shared", (F.col("shared") + F.col("whole")).alias("blocks"))
    w = Window.partitionBy("key").orderBy("comp").rowsBetween(Window.unboundedPreceding, -1)
    own = (sizes.where(big).withColumn("own", F.ceil(F.col("m") / block).cast("long"))
           .select("key", "comp", "own", F.coalesce(F.sum("own").over(w), F.lit(0)).alias("before")))
    rows = members.join(keys, "key").join(own, ["key", "comp"], "left")
    first = F.when(F.col("own").isNull(), F.lit(0)).otherwise(F.col("shared") + F.col("before"))
    rows = rows.withColumn("block", first + F.pmod(F.xxhash64("rid"), F.coalesce("own", "shared")))
    others = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    others = F.when(F.col("own").isNull(), others).otherwise(
        F.filter(others, lambda b: (b < F.col("shared") + F.col("before")) | (b >= F.col("shared") + F.col("before") + F.col("own"))))
    rows = rows.withColumn("other", F.explode(others))
    p, q = F.least("block", "other"), F.greatest("block", "other")
    return rows.select(F.xxhash64("key", p, q).alias("group"), "key", p.alias("p"), q.alias("q"), "block", "rid", "comp")


def across_pairs(stars: DataFrame, comps: DataFrame, sketches: DataFrame, decode: Callable, near: Callable,
                 partitions: int, block: int) -> DataFrame:
    """Distinct pairs (a, b) that share a key, whose rows are in different components, and
    whose ``sketches`` (rid, sketch) are near; not those with the key's first row, which the
    first round has tested. A key's rows are compared as blocks: see ``dealt_across``.
    ``decode`` reads a column of sketches as an array, and ``near(x, y)`` is the matrix of
    those of two arrays that are near."""
    members = stars.select("key", "rid").join(comps.withColumnRenamed("id", "rid"), "rid", "left").select(
        "key", "rid", F.coalesce("component", "rid").alias("comp"))
    rows = dealt_across(frozen(members, "members"), block).join(sketches, "rid")

    def run(batches):
        for left, right, (rid, comp, s) in block_pairs(
                batches, lambda b: [b.column(6).to_numpy(zero_copy_only=False), decode(b.column(7))]):
            apart = comp[left][:, None] != comp[right]
            if not apart.any():
                continue
            i, j = np.nonzero(apart & near(s[left], s[right]))
            a, b = rid[left[i]], rid[right[j]]
            yield pa.RecordBatch.from_pydict({"a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b))})

    return (rows.select("group", "key", "p", "q", "block", "rid", "comp", "sketch").repartition(partitions, "group")
            .sortWithinPartitions("group").mapInArrow(run, "a long, b long").distinct())


def objects(column) -> np.ndarray:
    """A column of byte strings as an array of objects."""
    out = np.empty(len(column), object)
    out[:] = column.to_pylist()
    return out


def dealt_in_blocks(groups: DataFrame, block: int) -> DataFrame:
    """(key, component, p, q, block, rid) of groups (id, component): a group's rows are dealt
    over blocks of about ``block`` rows, and a row goes to each pair (p, q) of its block and
    another, or itself. So a group of very many rows is dealt over many tasks."""
    sizes = groups.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    rows = (groups.join(sizes, "component")
            .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    p, q = F.least("block", "other"), F.greatest("block", "other")
    return rows.select(F.xxhash64("component", p, q).alias("key"), "component", p.alias("p"), q.alias("q"),
                       "block", F.col("id").alias("rid"))


def block_pairs(batches, rest: Callable):
    """Of a stream of dealt rows sorted by key: (left, right, columns) per pair of blocks, the
    places of the rows of both blocks; they are equal where p = q. ``rest(batch)`` gives the
    arrays of the columns after rid."""
    def columns(batch):
        return [*(batch.column(i).to_numpy(zero_copy_only=False) for i in range(6)), *rest(batch)]

    for x in whole_groups(batches, columns):
        key, comp, p, q, block = x[:5]
        for a, b in group_ranges(key):
            groups = sorted(set(zip(comp[a:b].tolist(), p[a:b].tolist(), q[a:b].tolist())))  # nearly always one
            for c, i, j in groups:
                at = a + np.flatnonzero((comp[a:b] == c) & (p[a:b] == i) & (q[a:b] == j))
                yield at[block[at] == i], at[block[at] == j], x[5:]


def lowest_reached(near: np.ndarray) -> np.ndarray:
    """Of a symmetric matrix of links, the lowest row that each row reaches."""
    label = np.arange(len(near))
    while True:
        new = np.minimum(label, np.where(near, label[None, :], len(near)).min(axis=1, initial=len(near)))
        new = new[new]
        if (new == label).all():
            return label
        label = new


def with_both(pairs: DataFrame, side: DataFrame) -> DataFrame:
    """(a, b, x, y): the value of ``side`` (rid, value) for both ends of the pairs."""
    rid, value = side.columns
    for end, name in (("a", "x"), ("b", "y")):
        pairs = pairs.join(side.select(F.col(rid).alias(end), F.col(value).alias(name)), end)
    return pairs.select("a", "b", "x", "y")
