"""Near-duplicate documents by one-permutation MinHash.

Texts become sets of word shingles (64-bit hashes). Documents with the same set are one
class; all further work is on classes. One hash of every shingle fills the bins of a
signature; empty bins take the value of another bin by optimal densification (a probe
sequence per bin that does not depend on the set). Bins in bands give buckets.

In each bucket star-shaped candidate links are formed first: all members with the member
of smallest priority, the same priority in all buckets so that a large group shares few
centres. Links are confirmed on the full sets. The second round takes only buckets that
still hold several components: all untested pairs where the bucket is small, stars around
STARS other centres where it is large. The stars only join what is easily joined; large
buckets that are still mixed then go through an exact similarity join (prefix filter on
the rarest shingles, with bounds on sizes and places), which leaves no pair between
different components untested.

Defined results
* words are runs outside white space (code points 9-13 and 32), A-Z lower-cased; a text
  with fewer words than a shingle has its whole sequence as its only shingle; a null or
  empty text or one without words has an empty set and is linked with nothing
* documents are linked when 100 x common >= percent x united shingles
* component_id is the smallest doc_id reachable by links; kept marks the document with
  that id; a null doc_id is ignored in the minimum; if all of a component are null,
  component_id is null and the documents are kept
* repeated rows give repeated result rows; an empty table gives none; other columns are
  not read
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import drop_fixed, fixed, join_counted, map_arrow, unwrapped, wrapped
from vigil.llm.components import components

#: bands x rows per band; at similarity 0.85 a pair misses all buckets with probability
#: (1 - 0.85^4)^20 = 2e-6, at 0.8 with 3e-5
BANDS, ROWS = 20, 4
#: buckets of at most so many members are compared pair by pair in the second round
SMALL_BUCKET = 32
#: centres of a large bucket, ROUND of them at a time, of buckets still mixed then; the
#: exact join behind them finds the rest, so their number decides work only
STARS, ROUND = 8, 4
#: members of a shingle's group in a block of the exact join
BLOCK = 256
#: members around one centre that are confirmed in one group
SALT_ROWS = 256
_PROBES = 512
_EMPTY = np.zeros(0, dtype=np.uint64)

SIGNED = ("doc_id long, rid long, rhash long, n_shingles long, cls binary, "
          "bands array<long>")


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None, k: int) -> np.ndarray:
    """The set of k-word shingles as sorted 64-bit hashes."""
    words = (text or "").encode().lower().split()
    if not words:
        return _EMPTY
    if len(words) < k:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(words) - k + 1
    total = np.zeros(n, np.uint64)
    for i in range(k):
        total = _mix(total + h[i:i + n])
    return np.unique(total)


@lru_cache(maxsize=4)
def _tables(bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower bounds of the bins in the hash range; the probe sequence of every bin."""
    bounds = np.array([i * 2**64 // bins for i in range(bins)], dtype=np.uint64)
    at = np.arange(bins, dtype=np.uint64)[None, :]
    turn = np.arange(1, _PROBES + 1, dtype=np.uint64)[:, None]
    probes = _mix(_mix(at + np.uint64(1)) + turn) % np.uint64(bins)
    return bounds, probes.astype(np.int64)


def signature(hashes: np.ndarray, bins: int) -> np.ndarray:
    """One-permutation signature of a non-empty sorted set: the smallest hash of each
    bin; an empty bin takes that of the first full bin on its probe sequence."""
    bounds, probes = _tables(bins)
    first = np.searchsorted(hashes, bounds)
    full = first < np.append(first[1:], len(hashes))
    source = np.arange(bins)
    empty = np.flatnonzero(~full)
    for row in probes:
        if not len(empty):
            break
        to = row[empty]
        found = full[to]
        source[empty[found]] = to[found]
        empty = empty[~found]
    if len(empty):
        source[empty] = np.flatnonzero(full)[0]
    return hashes[first[source]]


def band_hashes(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    part = sig.reshape(bands, rows)
    total = np.arange(1, bands + 1, dtype=np.uint64)
    for i in range(rows):
        total = _mix(total + part[:, i])
    return total.view(np.int64)


def _sign(k: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, classes, found = [], [], []
            for text in batch.column(3).to_pylist():
                s = shingles(text, k)
                sizes.append(len(s))
                if len(s):
                    classes.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    found.append(band_hashes(signature(s, bands * rows), bands, rows))
                else:
                    classes.append(None)
                    found.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(sizes, pa.int64()),
                 pa.array(classes, pa.binary()), pa.array(found, pa.list_(pa.int64()))],
                ["doc_id", "rid", "rhash", "n_shingles", "cls", "bands"])
    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t, k).view(np.int64) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["cid", "shingles"])
    return run


def _row(docs: DataFrame) -> list[Column]:
    doc_id = docs["doc_id"].cast("long")
    return [doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit(-1)).alias("rid"),
            F.xxhash64(doc_id.isNull(), F.coalesce(docs["text"], F.lit(""))).alias("rhash")]


def _similar(common: Column, a: Column, b: Column, percent: int) -> Column:
    return 100 * common >= percent * (a + b - common)


def _size_fits(a: Column, b: Column, percent: int) -> Column:
    """Sets of these sizes can be similar enough."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar. The pairs around one ``a`` are split
    into groups of about SALT_ROWS and its set is repeated for each, so no group is hot."""
    degree = fixed(pairs.groupBy("a").agg(F.count(F.lit(1)).alias("degree"))
                   .withColumn("parts", F.ceil(F.col("degree") / SALT_ROWS)))
    salted = fixed(join_counted(pairs, degree, "a", "degree").select(
        "a", "b", F.pmod(F.xxhash64("b"), "parts").alias("part")))
    centre = (degree.join(sets.withColumnRenamed("cid", "a"), "a")
              .select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
                      .alias("part"), F.col("shingles").alias("set_a")))
    member = salted.join(sets.select(F.col("cid").alias("b"), F.col("shingles").alias("set_b")),
                         "b")
    both = member.join(centre, ["a", "part"])
    common = F.size(F.array_intersect("set_a", "set_b"))
    found = fixed(both.filter(_similar(common, F.size("set_a"), F.size("set_b"), percent))
                  .select("a", "b"))
    drop_fixed(degree, salted)
    return found


def _stars(members: DataFrame, turns: range, percent: int) -> DataFrame:
    """Pairs (a, b) of the bucket's members of smallest priority, one for each turn's
    priorities, with its others."""
    stars, centres = [], []
    for turn in turns:
        priority = F.xxhash64(F.lit(turn), "cid")
        stars += [F.min_by(c, priority).alias(f"{c}{turn}") for c in ("cid", "n", "root")]
        centres.append(F.struct(F.col(f"cid{turn}").alias("a"), F.col(f"n{turn}").alias("na"),
                                F.col(f"root{turn}").alias("ra")))
    found = fixed(members.groupBy("bucket").agg(*stars, F.count(F.lit(1)).alias("n_members"))
                  .select("bucket", "n_members", F.array(*centres).alias("centres")))
    able = F.filter("centres", lambda c: (c["ra"] != F.col("root"))
                    & _size_fits(c["na"], F.col("n"), percent))
    return (join_counted(members, found, "bucket", "n_members")
            .select(F.col("cid").alias("b"), F.inline(able)).select("a", "b").distinct())


def _all_pairs(members: DataFrame, percent: int) -> DataFrame:
    """All pairs between components in buckets of at most SMALL_BUCKET members."""
    x = members.select("bucket", F.col("cid").alias("a"), F.col("n").alias("na"),
                       F.col("root").alias("ra"))
    y = members.select("bucket", F.col("cid").alias("b"), F.col("n").alias("nb"),
                       F.col("root").alias("rb"))
    return (x.join(y, "bucket").filter("a < b AND ra <> rb")
            .filter(_size_fits(F.col("na"), F.col("nb"), percent)).select("a", "b").distinct())


def _prefix(open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """s, cid, n, root, lead, at: the shingles by which a class can be found by one of
    another component, and their places in its set's order.

    Two similar sets share at least percent of either's shingles. Ordered alike (here those
    held by one component only first, then the rarest), each has a shared one among its
    first n - ceil(percent x n / 100) + 1; those of one component are shared with no other,
    so they only take up places. ``lead`` is the largest component among the holders."""
    classes = fixed(open_.select("cid", "n", "root").distinct())
    weight = fixed(classes.groupBy("root").agg(F.count(F.lit(1)).alias("weight")))
    classes = fixed(join_counted(classes, weight, "root", "weight"))
    tokens = fixed(sets.join(classes, "cid").select(
        "cid", "root", "weight", F.explode("shingles").alias("s")))
    shared = fixed(tokens.groupBy("s").agg(
        F.count(F.lit(1)).alias("holders"), F.min("root").alias("lo"), F.max("root").alias("hi"),
        F.max(F.struct("weight", "root")).alias("lead"))
        .filter("lo <> hi").select("s", "holders", F.col("lead.root").alias("lead")))
    found = (join_counted(tokens.select("cid", "s"), shared, "s", "holders").groupBy("cid")
             .agg(F.sort_array(F.collect_list(F.struct("holders", "s", "lead"))).alias("held"))
             .join(classes.drop("weight"), "cid"))
    length = F.col("n") - F.floor((percent * F.col("n") + 99) / 100) + 1
    alone = F.col("n") - F.size("held")
    out = fixed(found.withColumn("alone", alone).withColumn("most", length - alone)
                 .filter("most > 0")
                 .select("cid", "n", "root", "alone", F.posexplode(
                     F.slice("held", F.lit(1), F.col("most").cast("int"))).alias("at", "t"))
                 .select("t.s", "cid", "n", "root", "t.lead",
                         (F.col("alone") + F.col("at") + 1).alias("at")))
    drop_fixed(weight, tokens, shared)
    return out


def _prefix_pairs(open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All pairs between different components of ``open_`` that can be similar: those with
    a shingle of both prefixes whose places leave enough to share. Every pair has a member
    outside its group's largest component, so those are paired with all, block by block."""
    prefix = _prefix(open_, sets, percent)
    few = F.col("root") != F.col("lead")
    groups = fixed(prefix.groupBy("s").agg(F.count(F.lit(1)).alias("size"),
                                           F.count_if(few).alias("n_few"))
                   .filter("n_few > 0 AND size > 1")
                   .withColumn("rows", F.ceil(F.col("n_few") / BLOCK))
                   .withColumn("columns", F.ceil(F.col("size") / BLOCK))
                   .drop("n_few"))
    placed = fixed(join_counted(prefix, groups, "s", "size"))

    def blocks(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))

    def own(count: str) -> Column:
        return F.pmod(F.xxhash64("cid", "s"), count)

    x = placed.filter(few).select(
        "s", own("rows").alias("i"), blocks("columns").alias("j"), F.col("cid").alias("a"),
        F.col("n").alias("na"), F.col("root").alias("ra"), F.col("at").alias("at_a"))
    y = placed.select(
        "s", blocks("rows").alias("i"), own("columns").alias("j"), F.col("cid").alias("b"),
        F.col("n").alias("nb"), F.col("root").alias("rb"), F.col("at").alias("at_b"),
        few.alias("few"))
    left = 1 + F.least(F.col("na") - F.col("at_a"), F.col("nb") - F.col("at_b"))
    fits = ((F.col("ra") != F.col("rb")) & (~F.col("few") | (F.col("a") < F.col("b")))
            & _size_fits(F.col("na"), F.col("nb"), percent)
            & ((100 + percent) * left >= percent * (F.col("na") + F.col("nb"))))
    found = fixed(x.join(y, ["s", "i", "j"]).filter(fits)
                  .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    drop_fixed(prefix, groups, placed)
    return found


def _untested(pairs: DataFrame, tested: DataFrame) -> DataFrame:
    """Pairs that were not tested in either order."""
    known = tested.unionByName(tested.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return fixed(pairs.join(known, ["a", "b"], "left_anti"))


class NearDuplicates:
    """Classes and links of a document table.

    rows      doc_id, rid, rhash, n_shingles, cls of every document
    classes   cid, cls, min_id, n_docs, row (rid, rhash of one document), n, bands
    links     a, b: confirmed links between classes (cid)
    labels    node, root: components of the linked classes
    """

    def __init__(self, docs: DataFrame, k: int = 5, percent: int = 80,
                 bands: int = BANDS, rows: int = ROWS):
        self.percent = percent
        signed = fixed(map_arrow(docs.select(*_row(docs), docs["text"]),
                                 _sign(k, bands, rows), SIGNED))
        self.rows = signed.drop("bands")
        self.classes = fixed(
            signed.filter(F.col("cls").isNotNull()).groupBy("cls")
            .agg(F.min("doc_id").alias("min_id"), F.count(F.lit(1)).alias("n_docs"),
                 F.min(F.struct("rid", "rhash")).alias("row"),
                 F.any_value("n_shingles").alias("n"), F.any_value("bands").alias("bands"))
            .withColumn("cid", F.monotonically_increasing_id()))
        self.links, self.labels = self._link(docs, k)

    def _members(self) -> DataFrame:
        """bucket, cid, n of the classes that share a bucket with another one."""
        members = self.classes.select(F.explode("bands").alias("bucket"), "cid", "n")
        sizes = fixed(members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_members"))
                      .filter("n_members > 1"))
        return fixed(join_counted(members, sizes, "bucket", "n_members").drop("n_members"))

    def _class_sets(self, docs: DataFrame, members: DataFrame, k: int) -> DataFrame:
        """cid, shingles of the classes in ``members``, from one document of each."""
        wanted = (self.classes.select("cid", "row.rid", "row.rhash")
                  .join(members.select("cid").distinct(), "cid", "left_semi"))
        texts = (docs.select(*_row(docs), docs["text"]).drop("doc_id")
                 .join(wanted, ["rid", "rhash"]).select("cid", "text"))
        return fixed(map_arrow(texts, _sets(k), "cid long, shingles array<long>")
                     .dropDuplicates(["cid"]))

    def _mixed(self, members: DataFrame, labels: DataFrame, least: int) -> DataFrame:
        """bucket, cid, n, root, size of buckets of more than ``least`` members that hold
        several components."""
        root = labels.withColumnRenamed("node", "cid")
        now = fixed(members.join(root, "cid", "left")
                    .withColumn("root", F.coalesce("root", "cid")))
        mixed = fixed(now.groupBy("bucket").agg(
            F.min("root").alias("lo"), F.max("root").alias("hi"),
            F.count(F.lit(1)).alias("size"))
            .filter((F.col("lo") != F.col("hi")) & (F.col("size") > least))
            .select("bucket", "size"))
        return fixed(join_counted(now, mixed, "bucket", "size"))

    def _link(self, docs: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
        members = self._members()
        sets = self._class_sets(docs, members, k)
        tested = fixed(_stars(members.withColumn("root", F.col("cid")), range(1), self.percent))
        links = _confirm(tested, sets, self.percent)
        labels = components(links)
        for turn in range(1, 1 + STARS, ROUND):
            open_ = self._mixed(members, labels, 2 if turn == 1 else SMALL_BUCKET)
            large = F.col("size") > SMALL_BUCKET
            turns = range(turn, min(turn + ROUND, 1 + STARS))
            pairs = _stars(open_.filter(large), turns, self.percent)
            if turn == 1:
                small = _all_pairs(open_.filter(~large), self.percent)
                pairs = pairs.unionByName(small).distinct()
            pairs = _untested(pairs, tested)
            tested = tested.unionByName(pairs)
            links = links.unionByName(_confirm(pairs, sets, self.percent))
            labels = components(links)
        open_ = self._mixed(members, labels, SMALL_BUCKET)
        if open_.isEmpty():
            return links, labels
        pairs = _untested(_prefix_pairs(open_, sets, self.percent), tested)
        links = links.unionByName(_confirm(pairs, sets, self.percent))
        return links, components(links)

    def documents(self) -> DataFrame:
        """doc_id, rid, rhash, n_shingles, component_id, kept per row."""
        named = self.classes.join(self.labels.withColumnRenamed("node", "cid"), "cid", "left")
        named = fixed(named.select("cls", "min_id", "n_docs",
                                   F.coalesce("root", "cid").alias("root")))
        ids = fixed(named.groupBy("root").agg(F.min("min_id").alias("component_id"),
                                              F.count(F.lit(1)).alias("n_classes")))
        classes = fixed(join_counted(named, ids, "root", "n_classes"))
        found = join_counted(self.rows, classes.select("cls", "component_id", "n_docs"), "cls",
                             "n_docs").drop("n_docs", "cls")
        alone = (self.rows.filter(F.col("cls").isNull())
                 .withColumn("component_id", F.col("doc_id")).drop("cls"))
        return found.unionByName(alone).withColumn(
            "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def kept_documents(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One document (all columns) of every component: the one with the smallest id;
    documents without words all stay."""
    judged = NearDuplicates(docs, k, percent).documents().filter("kept")
    stay = judged.groupBy("rid", "rhash").agg(F.count(F.lit(1)).alias("n_rows"))
    found = wrapped(docs, *_row(docs)).join(stay, ["rid", "rhash"])
    repeated = found.filter("n_rows > 1").dropDuplicates(["rid", "rhash"])
    return unwrapped(found.filter("n_rows = 1").unionByName(repeated))
