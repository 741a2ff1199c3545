"""References to records that are missing, deleted or late.

Keys live on the ring of 64-bit hashes, which is cut into equal ranges; as hashes are uniform, the
ranges hold about equal numbers of keys at any fineness. Only a key that has more references than a
slot should get gets slots of its own, and only that key's parents are copied to them. In every slot
the parents form sorted arrays and the references, streamed as Arrow batches, are found in them by
binary search. Only misses leave the slot.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.functions.keys import key, month

#: Slots of ordinary keys, and slots' worth of references that hot keys may have: bounds of the number of partitions and
#: of the table of hot keys. Beyond them the slots grow; references are streamed, so only their parents must fit.
MOST_SLOTS = 50_000
SEEN = 500  #: references of a key of ``target`` rows that the search for hot keys sees on average
MISSING, LATE, DELETED = "missing", "late", "deleted"

_OUT = "tab string, rec_id bigint, field string, ref_key string, kind string, month int"
_SCHEMA = pa.schema([("tab", pa.string()), ("rec_id", pa.int64()), ("field", pa.string()), ("ref_key", pa.string()), ("kind", pa.string()), ("month", pa.int32())])


def hot_keys(refs: DataFrame, target: int) -> list[tuple[int, int]]:
    """(h, references) of the keys with more than ``target`` references, about.

    Counted over one of every target / SEEN rows, chosen by hash, so a key of that many rows is seen
    some SEEN times; at most rows / target * 1.25 keys come out. Whether a key close to the bound
    is found changes the size of slots alone, never the result.
    """
    every = max(1, target // SEEN)
    some = refs.where(F.pmod(F.xxhash64("rec_id", "tab", "field", F.lit(23)), F.lit(every)) == 0)
    counts = some.groupBy("h").agg((F.count("*") * every).alias("n")).where(F.col("n") > 0.8 * target)
    return [(r.h, r.n) for r in counts.orderBy("h").collect()]


class _Parents:
    """Sorted arrays of the parents of one slot."""

    def __init__(self, rows: pa.Table) -> None:
        # order: hash, key, month of arrival, time, rec_id; absent times come first
        rows = rows.sort_by([("h", "ascending"), ("key", "ascending"), ("m", "ascending"), ("us", "ascending"), ("rec_id", "ascending")])
        self.n = rows.num_rows
        if not self.n:
            return
        h, keys = rows["h"].to_numpy(), rows["key"].combine_chunks()
        new = np.ones(self.n, bool)
        if self.n > 1:
            same = pc.equal(keys.slice(1), keys.slice(0, self.n - 1)).to_numpy(zero_copy_only=False)
            new[1:] = (h[1:] != h[:-1]) | ~same
        self.start = np.flatnonzero(new)
        self.h, self.keys = h[self.start], keys.take(pa.array(self.start))
        group = np.cumsum(new) - 1
        self.m = rows["m"].to_numpy()
        self.first = self.m[self.start]
        self.at = group * (1 << 20) + self.m
        self.dead = pc.fill_null(rows["dead"], np.iinfo(np.int64).max).to_numpy()

    def kinds(self, h: np.ndarray, keys: pa.Array, m: np.ndarray, us: np.ndarray) -> np.ndarray:
        """0: fine, 1 missing, 2 late, 3 deleted. m < 0: the reference has no time, so only a missing key can be told."""
        if not self.n:
            return np.ones(len(h), np.int8)
        group = np.full(len(h), -1)
        pos = np.searchsorted(self.h, h)
        open_ = np.flatnonzero((pos < len(self.h)) & (self.h[np.minimum(pos, len(self.h) - 1)] == h))
        while len(open_):  # more than once only where two keys share a hash
            hit = pc.equal(self.keys.take(pa.array(pos[open_])), keys.take(pa.array(open_))).to_numpy(zero_copy_only=False)
            group[open_[hit]] = pos[open_[hit]]
            open_ = open_[~hit]
            pos[open_] += 1
            open_ = open_[(pos[open_] < len(self.h)) & (self.h[np.minimum(pos[open_], len(self.h) - 1)] == h[open_])]
        known = group >= 0
        g = np.maximum(group, 0)
        last = np.searchsorted(self.at, g * (1 << 20) + np.maximum(m, 0), side="right") - 1
        timed = known & (m >= 0)
        late = timed & (self.first[g] > m)
        gone = timed & ~late & (self.dead[np.maximum(last, 0)] <= us)
        return np.where(~known, 1, np.where(late, 2, np.where(gone, 3, 0))).astype(np.int8)


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = pa.array([None, MISSING, LATE, DELETED])
    held: list[pa.RecordBatch] = []
    parents: _Parents | None = None
    for batch in batches:  # parents (side 0) come first
        side = batch.column("side").to_numpy()
        split = int(np.searchsorted(side, 1))
        if split:
            held.append(batch.slice(0, split))
        refs = batch.slice(split)
        if not refs.num_rows:
            continue
        if parents is None:
            parents = _Parents(pa.Table.from_batches(held, batch.schema))
            held = []
        kind = parents.kinds(refs.column("h").to_numpy(), refs.column("key"), refs.column("m").to_numpy(), refs.column("us").to_numpy())
        miss = pa.array(np.flatnonzero(kind))
        if len(miss):
            bad = refs.take(miss)
            yield pa.RecordBatch.from_arrays([bad.column("tab"), bad.column("rec_id"), bad.column("field"), bad.column("raw"), kinds.take(pa.array(kind[miss.to_numpy()])), bad.column("m")], schema=_SCHEMA)


def orphans(references: DataFrame, parents: DataFrame, target: int = 200_000, parent_rows: int = 1_000_000) -> DataFrame:
    """Every reference whose parent is missing, late or deleted: (tab, rec_id, field, ref_key, kind, month).

    references: (tab, rec_id, field, to, ref, loaded_at), ``to`` naming the table referred to and
    ``ref`` the key as written; parents: (to, key, rec_id, loaded_at, deleted_at). References that
    are no key are no cases. A reference without loaded_at can only be ``missing`` (month -1); a
    parent without loaded_at counts as always there. Of parent rows loaded at the same time the one
    with the larger rec_id counts as the later. Repeated reference rows come out as often as they
    come in; empty tables give an empty result, or all references as missing. Other columns are
    ignored.

    target: references of one slot. parent_rows: parent rows of one slot, which are held in memory.
    The driver sees two row counts and the hot keys, at most 1.25 * MOST_SLOTS of them.
    """
    spark = references.sparkSession
    hashed = lambda k: F.xxhash64(F.col("to"), k)
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    references = references.select("tab", "rec_id", "field", "to", "ref", "loaded_at")
    parents = parents.select("to", "key", "rec_id", "loaded_at", "deleted_at")
    refs = references.withColumn("key", key(F.col("ref"))).where("key is not null").withColumn("h", hashed(F.col("key")))
    olds = parents.withColumn("key", key(F.col("key"))).where("key is not null").withColumn("h", hashed(F.col("key")))

    # keyless rows are counted too, so both counts come from the files alone where they can
    n, m = references.count(), parents.count()
    target = max(target, -(-n // MOST_SLOTS))
    ranges = max(2, min(MOST_SLOTS, -(-n // target)), -(-m // parent_rows))
    slot, hot = ranges, []
    for h, k in hot_keys(refs, target):
        many = -(-k // target)
        hot.append((h, slot, many))
        slot += many
    hot_ = F.broadcast(spark.createDataFrame(hot, "h bigint, first int, many int"))  # at most 1.25 * MOST_SLOTS rows
    range_ = F.least(F.floor((F.shiftrightunsigned("h", 11) / F.lit(float(1 << 53))) * ranges).cast("int"), F.lit(ranges - 1))
    left = (
        olds.join(hot_, "h", "left")
        .withColumn("slot", F.explode(F.when(F.col("first").isNull(), F.array(range_)).otherwise(F.sequence("first", F.col("first") + F.col("many") - 1))))
        .select("slot", F.lit(0).cast("tinyint").alias("side"), "h", "key", F.lit(None).cast("string").alias("tab"), "rec_id", F.lit(None).cast("string").alias("field"), F.lit(None).cast("string").alias("raw"), F.coalesce(month(F.col("loaded_at")), F.lit(0)).alias("m"), F.coalesce(us("loaded_at"), F.lit(-(1 << 62))).alias("us"), us("deleted_at").alias("dead"))
    )
    own = F.col("first") + F.pmod(F.xxhash64("rec_id"), F.col("many")).cast("int")
    right = refs.join(hot_, "h", "left").select(
        F.when(F.col("first").isNull(), range_).otherwise(own).alias("slot"), F.lit(1).cast("tinyint").alias("side"), "h", "key", "tab", "rec_id", "field",
        F.col("ref").alias("raw"), F.coalesce(month(F.col("loaded_at")), F.lit(-1)).alias("m"), F.coalesce(us("loaded_at"), F.lit(-(1 << 62))).alias("us"), F.lit(None).cast("bigint").alias("dead"),
    )
    laid = left.unionByName(right).repartitionById(slot, "slot").drop("slot")  # a partition for every slot
    return laid.sortWithinPartitions("side").mapInArrow(_probe, _OUT)


def report(misses: DataFrame) -> DataFrame:
    """Misses per table, field, kind and calendar month of arrival (YYYY-MM, null where unknown)."""
    m = F.col("month")
    name = F.when(m > 0, F.format_string("%04d-%02d", ((m - 1) / 12).cast("int"), ((m - 1) % 12 + 1).cast("int")))
    return misses.groupBy("tab", "field", "kind", name.alias("month")).agg(F.count("*").alias("n_refs"))
