"""Near-duplicate documents: fast similarity sketches, banding, and verification on full shingle sets.

Documents with equal sets form a class, and only one member of each goes on, so thousands of copies cost one. A pair of classes
at the similarity bound shares a band with a chance of more than 0.999996. Pairs are not listed group by group:
each round compares every class with one other, a leader of one of its band groups, on the full sets and finds components.
Groups whose members all belong to one component are done. What is left after a few rounds is small; there, members
outside a group's largest component meet all members of other components, so no link between components is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.session import settle

from .blocks import flat_of, in_arrow, map_slices, pick, rows_by_id
from .components import components
from .fast_sketch import band_keys, marks_of, sketches
from .shingles import digest_of, shingle_sets

#: Links have 100 * intersection >= 75 * union.
PERCENT = 75
#: 64 bands of 6 coordinates.
BANDS, ROWS = 64, 6
#: A pair goes to verification if at least so many coordinates agree in one byte. At the bound 288 of 384 agree on
#: average with a deviation of 8.5, so a linked pair has fewer with a chance below 1e-6.
COORDINATES, AGREEING = BANDS * ROWS, 245
#: Rounds with one leader for each class go on, up to ``LEADER_ROUNDS``, while comparing all that is left would make more than
#: ``PAIRS_EACH`` pairs for each member of a group and the last round has saved a fifth of them. All that is left is compared at the end.
LEADER_ROUNDS, PAIRS_EACH, SAVED = 6, 8, 0.2
#: Members of a group that one task compares with so many others, and others at a time.
PART, AT_ONCE = 512, 64
#: Tasks that the members of a group are dealt from.
COPIES = 32


def sketched(docs: DataFrame) -> DataFrame:
    """For each document doc_id, n_shingles, the set's digest (d1, d2), its band keys and coordinate bytes."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = list(shingle_sets(flat_of(batch)))
        sizes = np.array([len(s) for s in sets], np.int64)
        digests = np.array([digest_of(s) for s in sets], np.int64).reshape(-1, 2)
        found = marks_of(sketches([s for s in sets if len(s)], COORDINATES))
        keys, marks = iter(band_keys(found, ROWS)), iter(found)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), pa.array(sizes), pa.array(digests[:, 0]), pa.array(digests[:, 1]),
             pa.array([next(keys) if n else None for n in sizes], pa.list_(pa.int64())),
             pa.array([next(marks).tobytes() if n else None for n in sizes], pa.binary())],
            ["doc_id", "n_shingles", "d1", "d2", "keys", "marks"])

    return map_slices(pick(docs, "doc_id", "text"), work,
                      "doc_id bigint, n_shingles bigint, d1 bigint, d2 bigint, keys array<bigint>, marks binary")


def full_sets(docs: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """``column`` (the document's id) and its shingles for the settled, distinct ``ids`` (doc_id); one row for rows that repeat."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [s.view(np.int64) for s in shingle_sets(flat_of(batch))]
        return pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(sets, pa.list_(pa.int64()))], [column, "shingles"])

    texts = rows_by_id(docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"]), ids, "left_semi")
    found = map_slices(texts, work, f"{column} bigint, shingles array<bigint>")
    return found.groupBy(column).agg(F.max("shingles").alias("shingles"))


def _marks(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, COORDINATES)


def _agreeing(pairs: DataFrame) -> DataFrame:
    """Pairs (a, b, marks_a, marks_b) whose sketches agree often enough."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                close = (_marks(batch.column("marks_a")) == _marks(batch.column("marks_b"))).sum(axis=1) >= AGREEING
                yield batch.select(["a", "b"]).filter(pa.array(close))

    return in_arrow(pairs.select("a", "b", "marks_a", "marks_b"), run, "a bigint, b bigint")


class _Links:
    """Verified links between classes, and the components they make."""

    def __init__(self, docs: DataFrame, classes: DataFrame):
        self.docs, self.classes = docs, classes
        self.links: DataFrame | None = None

    def verify(self, pairs: DataFrame) -> None:
        """Adds those of the distinct ``pairs`` (a, b) that sketches allow and full sets confirm."""
        one = self.classes.select(F.col("class_id").alias("a"), F.col("marks").alias("marks_a"))
        two = self.classes.select(F.col("class_id").alias("b"), F.col("marks").alias("marks_b"))
        close = settle(_agreeing(pairs.join(one, "a").join(two, "b")))
        wanted = settle(close.select("a").union(close.select("b")).distinct().withColumnRenamed("a", "doc_id"))
        sets = settle(full_sets(self.docs, wanted, "doc_id"))
        one = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a"))
        two = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b"))
        common = F.size(F.array_intersect("set_a", "set_b"))
        union = F.size("set_a") + F.size("set_b") - common
        self.add(close.join(one, "a").join(two, "b").where(100 * common >= PERCENT * union).select("a", "b"))

    def add(self, found: DataFrame) -> None:
        found = settle(found)
        self.links = found if self.links is None else self.links.union(found)


def _groups(bands: DataFrame, named: DataFrame) -> DataFrame:
    """Band members with their components, of those groups only that have more than one."""
    members = bands.join(named.withColumnRenamed("node", "class_id"), "class_id", "left").withColumn(
        "component", F.coalesce("component", "class_id"))
    mixed = members.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least <> most")
    return settle(members.join(mixed.select("key"), "key"))


def _possible() -> F.Column:
    """Sets whose sizes alone do not rule out a link."""
    return 100 * F.least("size_a", "size_b") >= PERCENT * F.greatest("size_a", "size_b")


def _ordered(pairs: DataFrame) -> DataFrame:
    """Distinct (a, b) with a < b of the (class_id, size_a, other, size_b) that sizes allow."""
    return pairs.where(_possible()).select(F.least("class_id", "other").alias("a"), F.greatest("class_id", "other").alias("b")).distinct()


def _one_each(pairs: DataFrame, turn: int | None = None) -> DataFrame:
    """Of the partners that sizes allow one for each class: the smallest, or by a hash that changes with ``turn``."""
    rank = F.col("other") if turn is None else F.xxhash64("other", F.lit(turn))
    chosen = pairs.where(_possible()).groupBy("class_id", "size_a").agg(F.min(F.struct(rank.alias("rank"), "other", "size_b")).alias("own"))
    return _ordered(chosen.select("class_id", "size_a", "own.other", "own.size_b"))


def _with_leaders(groups: DataFrame, turn: int) -> DataFrame:
    """Each class outside a group's largest component with one member of that."""
    some = F.min(F.struct(F.xxhash64("class_id", F.lit(turn)), "class_id", "size")).alias("some")
    parts = groups.groupBy("key", "component").agg(F.count("*").alias("own"), some)
    leaders = parts.groupBy("key").agg(F.max(F.struct("own", "component", "some")).alias("top"))
    pairs = groups.join(leaders, "key").where(F.col("component") != F.col("top.component"))
    return _one_each(pairs.select("class_id", F.col("size").alias("size_a"), F.col("top.some.class_id").alias("other"), F.col("top.some.size").alias("size_b")), turn)


def _left(groups: DataFrame) -> tuple[int, int]:
    """Members of unfinished groups, and pairs that :func:`_all_left` would look at."""
    sizes = groups.groupBy("key", "component").agg(F.count("*").alias("own"))
    totals = sizes.groupBy("key").agg(F.sum("own").alias("all"), F.max("own").alias("most"))
    row = totals.agg(F.sum("all").alias("members"), F.sum(F.expr("(all - most) * all")).alias("pairs")).first()
    return row.members or 0, row.pairs or 0


def _all_left(docs: DataFrame, classes: DataFrame, groups: DataFrame) -> DataFrame:
    """Links (a, b) of members outside their group's largest component with members of other components.

    Groups with the same largest component are compared together, so a class is there once however many bands it shares.
    The members to be compared are cut into parts, and so are all members; each two parts meet in a place of their own, where the sketches and
    sets of one are held while the others pass by. So no task gets more than a few times ``PART`` members of a group. Only links become rows.
    """
    sizes = groups.groupBy("key", "component").agg(F.count("*").alias("own"))
    largest = sizes.groupBy("key").agg(F.max(F.struct("own", "component")).alias("top")).select("key", F.col("top.component").alias("largest"))
    members = settle(groups.join(largest, "key").select("largest", "class_id", "size", "component").distinct())
    in_parts = f"cast(ceil(count({{}}) / {PART}) as int)"
    counts = members.groupBy("largest").agg(F.expr(in_parts.format("nullif(component = largest, true)")).alias("parts"), F.expr(in_parts.format("*")).alias("slices"))
    wanted = settle(members.select(F.col("class_id").alias("doc_id")).distinct())
    known = settle(classes.select("class_id", "marks").join(full_sets(docs, wanted, "class_id"), "class_id"))
    place = F.expr("""explode(concat(
        if(component <> largest, transform(sequence(0, slices - 1),
            slice -> struct(cast(pmod(xxhash64(class_id), parts) as int) as part, slice, false as passing)), array()),
        transform(sequence(0, parts - 1), part -> struct(part, cast(pmod(xxhash64(class_id), slices) as int) as slice, true as passing)))) as place""")
    # Each group's counts come in some copies, so that the rows of a large group meet them in several tasks.
    copies = counts.where("parts > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
    spread = members.withColumn("copy", F.pmod(F.xxhash64("class_id"), F.lit(COPIES)).cast("int"))
    dealt = spread.join(copies, ["largest", "copy"]).select("largest", "class_id", "size", "component", place)
    dealt = dealt.select("largest", "place.part", "place.slice", "place.passing", "class_id", "size", "component").join(known, "class_id")

    def run(batches):
        at, waiting = None, []
        for batch in batches:
            places = np.column_stack([batch.column(name).to_numpy() for name in ("largest", "part", "slice")])
            passing = batch.column("passing").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((np.diff(places, axis=0) != 0).any(axis=1) | (np.diff(passing.astype(np.int8)) != 0)) + 1
            for begin, end in zip([0, *edges], [*edges, batch.num_rows], strict=True):
                if begin == end:
                    continue
                rows = batch.slice(begin, end - begin)
                if at != tuple(places[begin]):
                    at, waiting = tuple(places[begin]), []
                if not passing[begin]:
                    waiting.append(rows)
                    continue
                if len(waiting) > 1:
                    waiting = [pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]]
                for k in range(0, rows.num_rows if waiting else 0, AT_ONCE):
                    if (found := _compared(waiting[0], rows.slice(k, AT_ONCE))).num_rows:
                        yield found

    dealt = dealt.repartition("largest", "part", "slice").sortWithinPartitions("largest", "part", "slice", "passing")
    return in_arrow(dealt, run, "a bigint, b bigint").distinct()


def _compared(held: pa.RecordBatch, others: pa.RecordBatch) -> pa.RecordBatch:
    """Links between two sets of rows: pairs of different components that share a band and whose sizes, sketches and sets are similar enough."""
    one, two = ({c: rows.column(c).to_numpy() for c in ("class_id", "size", "component", "largest")} for rows in (held, others))
    fits = one["component"][:, None] != two["component"]
    fits &= (two["component"] == two["largest"]) | (one["class_id"][:, None] < two["class_id"])
    fits &= 100 * np.minimum(one["size"][:, None], two["size"]) >= PERCENT * np.maximum(one["size"][:, None], two["size"])
    left, right = np.nonzero(fits)
    same = _marks(held.column("marks"))[left] == _marks(others.column("marks"))[right]
    close = np.flatnonzero(same.sum(axis=1) >= AGREEING)
    close = close[same[close].reshape(len(close), BANDS, ROWS).all(axis=2).any(axis=1)]
    links = []
    for i, j in zip(left[close], right[close], strict=True):
        set_a, set_b = (rows.column("shingles")[int(k)].values.to_numpy() for rows, k in ((held, i), (others, j)))
        common = len(np.intersect1d(set_a, set_b, assume_unique=True))
        if 100 * common >= PERCENT * (len(set_a) + len(set_b) - common):
            links.append(sorted((one["class_id"][i], two["class_id"][j])))
    a, b = zip(*links, strict=True) if links else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def near_classes(docs: DataFrame) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Documents are linked when their shingle sets are similar enough; ``component_id`` is the smallest doc_id that is
    reachable, ``kept`` says whether it is the document's own. Documents without words are linked with nothing. A null
    text is empty. Documents need distinct ids: rows that repeat are returned as often as they are there, and all of them share the group of their text; a null id stands for itself and is never linked. An empty table gives no rows; other columns are not read.
    """
    named_docs = pick(docs, "doc_id", "text")
    rows = settle(sketched(named_docs))
    own = rows.where("doc_id is not null and n_shingles > 0")
    classes = settle(own.groupBy("d1", "d2", "n_shingles").agg(
        F.min("doc_id").alias("class_id"), F.min("keys").alias("keys"), F.min("marks").alias("marks")))
    shared = classes.select("class_id", F.col("n_shingles").alias("size"), F.explode("keys").alias("key"))
    leaders = shared.groupBy("key").agg(F.min(F.struct("class_id", "size")).alias("leader"), F.count("*").alias("members")).where("members > 1")
    bands = settle(shared.join(leaders, "key").select("key", "class_id", "size", "leader"))
    links = _Links(named_docs, classes)
    links.verify(_one_each(bands.where("class_id <> leader.class_id").select(
        "class_id", F.col("size").alias("size_a"), F.col("leader.class_id").alias("other"), F.col("leader.size").alias("size_b"))))
    bands = bands.drop("leader")
    found, before = settle(components(links.links)), None
    for turn in range(LEADER_ROUNDS + 1):
        groups = _groups(bands, found)
        members, pairs = _left(groups)
        if not members:
            break
        last = turn == LEADER_ROUNDS or pairs <= PAIRS_EACH * members or (before is not None and pairs > (1 - SAVED) * before)
        if last:
            links.add(_all_left(named_docs, classes, groups))
        else:
            links.verify(_with_leaders(groups, turn))
        found, before = settle(components(links.links)), pairs
        if last:
            break
    ids = classes.select("d1", "d2", "n_shingles", "class_id").join(found.withColumnRenamed("node", "class_id"), "class_id", "left")
    ids = ids.select("d1", "d2", "n_shingles", F.coalesce("component", "class_id").alias("_found"))
    linked = own.select("doc_id", "n_shingles", "d1", "d2").join(ids, ["d1", "d2", "n_shingles"]).select("doc_id", "n_shingles", "_found")
    alone = rows.where("doc_id is null or n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("_found"))
    return linked.union(alone).select("doc_id", "n_shingles", F.col("_found").alias("component_id"),
                                      F.coalesce(F.col("doc_id") == F.col("_found"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that :func:`near_classes` does not keep; all columns stay."""
    dropped = settle(near_classes(docs).where("not kept").select("doc_id").distinct())
    return rows_by_id(docs, dropped, "left_anti").select(*docs.columns)
