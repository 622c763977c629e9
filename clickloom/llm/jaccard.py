"""N-gram Jaccard join that uses relations between sets.

A document is the set of hashes (64 bits) of its runs of ``WORDS`` words. Documents with equal sets are one node.
Two nodes link at ``100 * intersection >= PERCENT * union``.

Index. Shingles are ordered: those that only one document has come first (a bitmap over all documents tells which
may occur twice), then by hash. Linked sets share a shingle in the first ``n - ceil(PERCENT n / 100) + 1`` places, so
only those of these places that may occur twice are listed; most documents list nothing. Entries of a list are
skipped against each other when their sizes, the places of the shingle, or a parity sketch of 512 bits (which differs in
at most ``|x - y| + |y - x|`` bits) rule a link out.

Set relations. In each list and size class the node with the smallest share of shingles of its own is the leader.
Every node is compared with the leader it shares most lists with; if they link it joins that leader's star. Connected
nodes are not compared again. For what is left open across components the leaders' overlap is counted once a
pair of stars, and the answers of the members follow from ``|x & y| <= |Lx & Ly| + |x - Lx| + |y - Ly|`` and
``|x & y| >= |Lx & Ly| - |Lx - x| - |Ly - y|``. Only members that both bounds leave open are counted themselves.
Entries are first held against the few that follow them in a list, and what that connects is left out when
all others follow. So a group of near copies costs a few comparisons a copy, and no link between different texts is lost.

Edge cases: null text or text without words has the empty set, links with nothing and is its own component; with
fewer than ``WORDS`` words the whole sequence is one shingle; a component of null ids only has a null
``component_id``; repeated rows are copies of each other; an empty table gives an empty result. Only ``doc_id`` and
``text`` are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from clickloom.llm import seen
from clickloom.llm.common import documents, register, write_and_read
from clickloom.llm.components import components

WORDS, PERCENT = 4, 85
CHARS_PER_SLOT = 4  # of the bitmap: a shingle or two in each used slot at most
CACHED_WORDS = 100_000
SKETCH = 8  # words of 64 bits
# Entries after it in a list that a node is compared with before it is compared with all that are left.
NEIGHBOURS = 6

_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)

Batches = Iterator[pa.RecordBatch]


class _WordHashes(dict):
    """Hash of each word met so far."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Shingler:
    """Shingle sets of texts: sorted distinct 64-bit hashes."""

    def __init__(self, width: int):
        self.width, self.hashes = width, _WordHashes()
        self.factors = np.resize(_FACTORS, width) * (np.arange(width, dtype=np.uint64) * np.uint64(2) + np.uint64(1))

    def __call__(self, text: str | None) -> np.ndarray:
        words = text.encode().lower().split() if text else []  # bytes: lower-cases A-Z, splits at the six white bytes
        if not words:
            return np.empty(0, np.uint64)
        if len(self.hashes) > CACHED_WORDS:
            self.hashes.clear()
        h = np.fromiter(map(self.hashes.__getitem__, words), np.uint64, len(words))
        with np.errstate(over="ignore"):
            width = min(self.width, len(h))
            total = np.full(len(h) - width + 1, width, np.uint64)
            for i in range(width):
                total += h[i : len(h) - width + 1 + i] * self.factors[i]
            return np.unique(_mixed(total))


def least_overlap(a: Column, b: Column, percent: int) -> Column:
    """Smallest intersection with which sets of these sizes link."""
    return F.ceil((a + b) * percent / (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def _text_arrays(width: int):
    def run(batches: Batches) -> Iterator[np.ndarray]:
        shingle = Shingler(width)
        for batch in batches:
            for text in batch.column(0):
                yield shingle(text.as_py()).view(np.int64)

    return run


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Parity of the shingles that fall on each of 512 bits. Two sketches differ in at most ``|x ^ y|`` bits."""
    odd = np.bincount((shingles >> np.uint64(20)).astype(np.int64) & (64 * SKETCH - 1), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _lister(width: int, percent: int, shared, slots: int):
    """(doc_id, node, n, once, tokens, sketch): a document's listed shingles, and how many come before them."""

    def run(batches: Batches) -> Batches:
        shingle, bits = Shingler(width), np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            nodes, sizes, first, tokens, sketches = [], [], [], [], []
            for text in batch.column("text"):
                s = shingle(text.as_py())
                again = seen.suspects(s.view(np.int64), bits, slots, 1)
                once = len(s) - int(again.sum())
                listed = s[again][: max(0, prefix_length(len(s), percent) - once)] if len(s) else s
                nodes.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                sizes.append(len(s))
                first.append(once)
                tokens.append(listed.view(np.int64))
                sketches.append(sketch(s) if len(listed) else np.empty(0, np.int64))
            columns = [batch.column("doc_id"), pa.array(nodes, pa.binary()), pa.array(sizes, pa.int32()), pa.array(first, pa.int32())]
            columns += [_lists(tokens), _lists(sketches)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "node", "n", "once", "tokens", "sketch"])

    return run


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int64), *parts])))


def _set_maker(width: int, shared, slots: int):
    """(node, shingles) of the documents whose key is in the bitmap."""

    def run(batches: Batches) -> Batches:
        shingle, bits = Shingler(width), np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            wanted = seen.suspects(batch.column("key").to_numpy(zero_copy_only=False), bits, slots, 1)
            sets = [shingle(batch.column("text")[i].as_py()).tobytes() for i in np.flatnonzero(wanted).tolist()]
            sets = [s for s in sets if s]
            nodes = [hashlib.blake2b(s, digest_size=16).digest() for s in sets]
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(sets, pa.binary())], ["node", "shingles"])

    return run


def _overlaps(batches: Batches) -> Batches:
    for batch in batches:
        n = []
        for a, b in zip(batch.column("sa"), batch.column("sb"), strict=True):
            a, b = np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64)
            if len(a) > len(b):
                a, b = b, a
            at = np.searchsorted(b, a)
            n.append(int((b[np.minimum(at, len(b) - 1)] == a).sum()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array(n, pa.int32())], ["a", "b", "overlap"]
        )


class Join:
    """One run of the join; the methods are its steps."""

    def __init__(self, docs: DataFrame, width: int = WORDS, percent: int = PERCENT):
        self.docs = docs.select("doc_id", "text")
        self.spark: SparkSession = docs.sparkSession
        self.width, self.percent = width, percent

    # -- index ----------------------------------------------------------------------------------

    def listed(self) -> DataFrame:
        """Members: one row per document, with its listed shingles."""
        chars = self.docs.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
        slots = seen.slots_for(max(1, chars // CHARS_PER_SLOT), 1)
        again = seen.bitmap(self.docs.select("text"), slots, 1, arrays=_text_arrays(self.width))
        shared = self.spark.sparkContext.broadcast(again)  # at most MAX_SLOTS bits
        id_type = self.docs.schema["doc_id"].dataType.simpleString()
        schema = f"doc_id {id_type}, node binary, n int, once int, tokens array<long>, sketch array<long>"
        return write_and_read(self.docs.mapInArrow(_lister(self.width, self.percent, shared, slots), schema), "jaccard-members")

    def postings(self, members: DataFrame) -> DataFrame:
        """(token, node, n, place, once, sketch) of the shingles that several nodes list."""
        nodes = members.filter(F.size("tokens") > 0).groupBy("node").agg(F.first(F.struct("n", "once", "tokens", "sketch")).alias("of"))
        nodes = write_and_read(nodes.select("node", "of.*"), "jaccard-nodes")
        entries = nodes.select("node", "n", "once", F.posexplode("tokens").alias("at", "token"))
        lists = entries.groupBy("token").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
        shared = lists.filter(F.col("lo") != F.col("hi")).select("token")
        shared = entries.join(shared, "token", "left_semi")
        sketches = nodes.select("node", *[F.col("sketch")[i].alias(f"s{i}") for i in range(SKETCH)])
        placed = shared.select("token", "node", "n", "once", (F.col("once") + F.col("at")).alias("place"))
        return write_and_read(placed.join(sketches, "node"), "jaccard-postings")

    def sets(self, members: DataFrame, postings: DataFrame) -> DataFrame:
        """(node, shingles) of the nodes that share a list, each once."""
        nodes = postings.select("node").distinct()
        first = members.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
        wanted = write_and_read(first.join(nodes, "node", "left_semi").select(F.xxhash64("doc_id").alias("key")), "jaccard-wanted")
        slots = seen.slots_for(wanted.count(), 16)
        bits = seen.bitmap(wanted.select(F.array("key")), slots, 1, times=1)
        shared = self.spark.sparkContext.broadcast(bits)
        keyed = self.docs.select("text", F.xxhash64("doc_id").alias("key"))
        made = keyed.mapInArrow(_set_maker(self.width, shared, slots), "node binary, shingles binary")
        return write_and_read(made.dropDuplicates(["node"]), "jaccard-sets")

    # -- comparison -----------------------------------------------------------------------------

    def compared(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """Exact ``overlap`` of pairs (a, b)."""
        left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
        right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
        joined = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "sa", "sb")
        return joined.mapInArrow(_overlaps, "a binary, b binary, overlap int")

    def _links(self, overlap: Column, a: Column, b: Column) -> Column:
        return overlap >= least_overlap(a, b, self.percent)

    def _near(self, a: str, b: str, of: dict[str, Column] | None = None) -> Column:
        """Whether two entries of a list may belong to a link that has its first shingle in common there.

        Sizes, places and sketches can only rule a link out. Columns are named by side, or taken from ``of``.
        """
        get = of.__getitem__ if of else F.col
        na, nb = get(f"n{a}"), get(f"n{b}")
        left = F.least(na - get(f"place{a}"), nb - get(f"place{b}"))
        apart = sum((F.bit_count(get(f"s{i}{a}").bitwiseXOR(get(f"s{i}{b}"))) for i in range(SKETCH)), F.lit(0))
        return self._links(F.least(na, nb), na, nb) & self._links(left, na, nb) & (apart <= na + nb - least_overlap(na, nb, self.percent) * 2)

    def stars(self, postings: DataFrame, sets: DataFrame) -> DataFrame:
        """(node, n, leader, ln, overlap): every node of the lists with the leader it links with, or itself."""
        size = F.floor(F.log(F.col("n").cast("double")) / -math.log(self.percent / 100)).cast("int")
        entries = postings.withColumn("size", size)
        # The leader is the node with the smallest share of shingles of its own: the likely centre of a family.
        own = [c for c in postings.columns if c not in ("token", "once")]
        centre = F.struct((F.col("once") / F.col("n")).alias("share"), *own)
        lead = entries.groupBy("token", "size").agg(F.min(centre).alias("lead"))
        lead = lead.select("token", "size", *[F.col(f"lead.{c}").alias(f"{c}_l") for c in own])
        votes = entries.join(lead, ["token", "size"]).withColumnsRenamed({c: f"{c}_x" for c in own})
        votes = votes.filter((F.col("node_x") != F.col("node_l")) & self._near("_x", "_l"))
        votes = votes.groupBy(F.col("node_x").alias("node"), F.col("n_x").alias("n"), F.col("node_l").alias("leader"), F.col("n_l").alias("ln"))
        votes = votes.agg(F.count("*").alias("votes"))
        best = F.max(F.struct("votes", "leader", "ln")).alias("best")
        chosen = votes.groupBy("node", "n").agg(best).select("node", "n", "best.leader", "best.ln")
        chosen = write_and_read(chosen, "jaccard-choices")
        done = self.compared(chosen.select(F.col("node").alias("a"), F.col("leader").alias("b")), sets)
        joined = chosen.join(done.withColumnsRenamed({"a": "node", "b": "leader"}), ["node", "leader"])
        linked = write_and_read(joined.filter(self._links(F.col("overlap"), F.col("n"), F.col("ln"))), "jaccard-stars")
        rest = postings.groupBy("node").agg(F.first("n").alias("n")).join(linked, "node", "left_anti")
        rest = rest.select("node", "n", F.col("node").alias("leader"), F.col("n").alias("ln"), F.col("n").alias("overlap"))
        return write_and_read(linked.select(rest.columns).unionByName(rest), "jaccard-stars")

    def _neighbours(self, placed: DataFrame) -> DataFrame:
        """Pairs (a, b) of entries that follow each other closely in a list, in an order of its own."""
        entry = F.struct(*[F.col(c) for c in placed.columns if c != "token"])
        order = W.partitionBy("token").orderBy(F.xxhash64("token", "node"))
        with_next = placed.withColumn("next", F.array(*[F.lead(entry, i).over(order) for i in range(1, NEIGHBOURS + 1)]))

        def near(x: Column) -> Column:
            sides = {**{f"{c}_a": F.col(c) for c in placed.columns}, **{f"{c}_b": x[c] for c in placed.columns if c != "token"}}
            return x.isNotNull() & (sides["component_a"] != sides["component_b"]) & self._near("_a", "_b", sides)

        pair = lambda x: F.struct(x["node"].alias("node"), x["n"].alias("n"))
        met = with_next.select("node", "n", F.explode(F.transform(F.filter("next", near), pair)).alias("other"))
        return met.select(F.col("node").alias("a"), F.col("other.node").alias("b"), F.col("n").alias("n_a"), F.col("other.n").alias("n_b"))

    def neighbour_links(self, postings: DataFrame, stars: DataFrame, sets: DataFrame) -> DataFrame:
        """Links between close entries of different stars. They connect most of a family at a few comparisons a node."""
        placed = postings.drop("once").join(stars.select("node", F.col("leader").alias("component")), "node")
        pairs = write_and_read(self._neighbours(placed).dropDuplicates(["a", "b"]), "jaccard-pairs")
        done = self.compared(pairs, sets).join(pairs, ["a", "b"])
        return done.filter(self._links(F.col("overlap"), F.col("n_a"), F.col("n_b"))).select("a", "b")

    def open_pairs(self, postings: DataFrame, stars: DataFrame, labels: DataFrame) -> DataFrame:
        """Pairs (a, b) of unconnected nodes that may link, with sizes, leaders and overlaps with their leaders."""
        nodes = _labelled(stars.drop("n"), labels, "node", "component")
        placed = postings.drop("once").join(nodes, "node")
        mixed = placed.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
        mixed = mixed.filter(F.col("lo") != F.col("hi")).select("token")
        # Written, so that the join below deals its rows itself and can split a frequent shingle.
        placed = write_and_read(placed.join(mixed, "token", "left_semi"), "jaccard-open")
        one, two = (placed.select("token", *[F.col(c).alias(f"{c}_{i}") for c in placed.columns if c != "token"]) for i in "ab")
        pairs = one.join(two, "token").filter(
            (F.col("node_a") < F.col("node_b")) & (F.col("component_a") != F.col("component_b")) & self._near("_a", "_b")
        )
        known = [F.col(f"{c}_{i}") for c in ("n", "leader", "ln", "overlap") for i in "ab"]
        pairs = pairs.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"), *known)
        return write_and_read(pairs.dropDuplicates(["a", "b"]), "jaccard-pairs")

    def open_links(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """Links (a, b) of open pairs: derived from the answers of their leaders, counted where these leave it open.

        The overlap of two leaders is counted once a pair of stars.
        """
        leaders = pairs.select(F.col("leader_a").alias("a"), F.col("leader_b").alias("b")).distinct()
        answers = self.compared(leaders, sets)
        answers = answers.select(F.col("a").alias("leader_a"), F.col("b").alias("leader_b"), F.col("overlap").alias("answer"))
        n_a, n_b = F.col("n_a"), F.col("n_b")
        top = F.col("answer") + (n_a - F.col("overlap_a")) + (n_b - F.col("overlap_b"))
        floor = F.col("answer") - (F.col("ln_a") - F.col("overlap_a")) - (F.col("ln_b") - F.col("overlap_b"))
        known = pairs.join(answers, ["leader_a", "leader_b"]).withColumns(
            {
                "joined": self._links(F.col("answer"), F.col("ln_a"), F.col("ln_b")),  # then so are all members
                "sure": self._links(floor, n_a, n_b),
                "possible": self._links(top, n_a, n_b),
            }
        )
        known = write_and_read(known.select("a", "b", "n_a", "n_b", "leader_a", "leader_b", "joined", "sure", "possible"), "jaccard-answers")
        joined = known.filter("joined").select(F.col("leader_a").alias("a"), F.col("leader_b").alias("b")).distinct()
        sure = known.filter("sure AND NOT joined").select("a", "b")
        left = known.filter("possible AND NOT sure AND NOT joined").select("a", "b", "n_a", "n_b")
        counted = self.compared(left, sets).join(left, ["a", "b"]).filter(self._links(F.col("overlap"), n_a, n_b))
        return joined.unionByName(sure).unionByName(counted.select("a", "b"))

    def run(self) -> DataFrame:
        """(doc_id, n_shingles, component_id), one row per document."""
        members = self.listed()
        postings = self.postings(members)
        sets = self.sets(members, postings)
        stars = self.stars(postings, sets)
        edges = stars.filter(F.col("node") != F.col("leader")).select(F.col("node").alias("a"), F.col("leader").alias("b"))
        edges = write_and_read(edges.unionByName(self.neighbour_links(postings, stars, sets)), "jaccard-edges")
        labels = components(edges)
        pairs = self.open_pairs(postings, stars, labels)
        if not pairs.isEmpty():
            more = labels.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(self.open_links(pairs, sets))
            labels = components(more)
        return self.result(members, labels)

    def result(self, members: DataFrame, labels: DataFrame) -> DataFrame:
        placed = _labelled(members.select("doc_id", "node", "n"), labels, "node", "component")
        first = placed.filter("node is not null").groupBy("component").agg(F.min("doc_id").alias("first"))
        joined = placed.join(first, "component", "left")
        component_id = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("first"))
        return joined.select("doc_id", F.col("n").cast("long").alias("n_shingles"), component_id.alias("component_id"))


def _labelled(df: DataFrame, labels: DataFrame, key: str, out: str) -> DataFrame:
    """Add the component of a node; a node without links is its own."""
    named = labels.select(F.col("node").alias(key), F.col("component").alias(out))
    return df.join(named, key, "left").withColumn(out, F.coalesce(out, key))


def jaccard_components(docs: DataFrame, width: int = WORDS, percent: int = PERCENT) -> DataFrame:
    return Join(docs, width, percent).run()


def representatives(docs: DataFrame, width: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One document of each component, the one with the smallest id, with its own columns.

    Documents without words stay. Null ids come after all others; of rows with one id the one with the smaller hash of its
    text is first; of rows equal in id and text one stays.
    """
    text = F.coalesce("text", F.lit(""))
    keys = {"__none": F.col("doc_id").isNull(), "__key1": F.xxhash64(F.lit(1), text), "__key2": F.xxhash64(F.lit(2), text)}
    keyed = docs.withColumns(keys)
    row = F.struct("__none", "doc_id", "__key1", "__key2")
    ids = jaccard_components(keyed.select(row.alias("doc_id"), "text"), width, percent)
    stays = ids.filter(F.col("doc_id") == F.col("component_id")).select("doc_id.*").distinct()
    stays = stays.select(F.col("doc_id").alias("__id"), F.col("__key1").alias("__k1"), F.col("__key2").alias("__k2"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__key1") == F.col("__k1")) & (F.col("__key2") == F.col("__k2"))
    kept = keyed.join(write_and_read(stays, "jaccard-stays"), same, "left_semi")
    repeats = W.partitionBy("doc_id", "__key1", "__key2").orderBy(*[F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")], F.lit(0))
    return kept.withColumn("__n", F.row_number().over(repeats)).filter("__n = 1").select(*[F.col(f"`{c}`") for c in docs.columns])


@register("op3_set_relation_jaccard")
def op3_set_relation_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir))
