"""Near copies by the Jaccard similarity of word shingles: every pair at ``SIMILARITY`` or more.

A text is the set of its shingles of ``SHINGLE`` lower-case words (a shorter text is one shingle),
each a 64-bit hash; equal sets are one node. Nodes whose SimHash fingerprints are within the radius of
``simhash_segments`` are linked first, through its popcount grid. A fingerprint can't tell all pairs
at the similarity (most differ in 3 to 16 bits), so the rest comes through keys of the sets.

Of two sets at similarity s, the first (1 - s) * n + 1 of the n shingles of each, in any one order of
all shingles, have one in common (prefix filter), so these are a set's keys and no pair at the
similarity is missed. The order puts shingles first that are rare in a sample of documents
(``SAMPLE_DOCS``), so that passages that many documents share are keys of few; the sample changes
the order alone, never the result.

Sets that share a key are candidates, if by the places of their first common key in that order enough shingles can follow it:
sets of n and m shingles have 4/9 (n + m) in common, and none before it. So the smaller set has it among its
first ninth, and a key that only stands further back (as a template's, behind each document's own words) joins nobody.
In a few rounds (``HUBS``), each key's members are compared to
one of them, chosen by hash so that keys of like members choose the same. Members that are still in
different components are then compared to each other, in blocks of bounded size: each member first
to its nearest by sketch, then to eight times as many in each round, until none is left. A parity
sketch has a bit that flips for each shingle that only one set has, so sketches never differ in more bits
than the sets differ in shingles; pairs whose sketches allow the similarity are compared exactly.

Rules: null, empty and blank texts are copies of each other; rows that repeat a doc_id are one
document; rows without doc_id get a null component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.llm import simhash_segments
from seqloom.llm.common import discard, sized_broadcast, text_batches, written
from seqloom.llm.simhash_segments import components

SHINGLE = 5
#: The similarity as a fraction, so that bounds are whole numbers.
SIMILARITY = (4, 5)
#: About so many documents are sampled for the order of shingles; at most so many shingles are known as frequent,
#: being in at least so many of the sampled documents.
SAMPLE_DOCS, FREQUENT, FREQUENT_DOCS = 20_000, 200_000, 3
SEED = 7
#: Sketch bits per shingle, at least, and most bits of a sketch.
SKETCH, SKETCH_BITS = 1, 1 << 15
#: Rounds in which the members of a key are compared to one of them.
HUBS = 1
#: Members of a key that are compared to each other in one group, and pairs in memory at once.
BLOCK, _PAIRS = 1024, 1 << 17


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None) -> np.ndarray:
    """The sorted different hashes of the text's shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if len(words) <= SHINGLE:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    found = [digest(joined[a:b], SEED) for a, b in zip(starts[: -SHINGLE + 1].tolist(), ends[SHINGLE - 1 :].tolist(), strict=True)]
    return np.unique(np.array(found, np.uint64))


def set_id(found: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(found.tobytes(), SEED) - (1 << 63)


def keys(found: np.ndarray, frequent: np.ndarray | None = None, times: np.ndarray | None = None) -> np.ndarray:
    """The shingles of which two sets at the similarity share at least one.

    frequent, times: sorted shingles known as frequent, and in how many sampled documents they are.
    """
    n = len(found)
    top, bottom = SIMILARITY
    most = n - -(-n * top // bottom) + 1
    if frequent is None or not len(frequent):
        return found[:most].view(np.int64)
    at = np.minimum(np.searchsorted(frequent, found), len(frequent) - 1)
    weight = np.where(frequent[at] == found, times[at], 0)
    return found[np.argsort(weight, kind="stable")[:most]].view(np.int64)  # found is sorted, so ties go by hash


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    top, bottom = SIMILARITY
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common * bottom >= top * (len(a) + len(b) - common)


def sketch(found: np.ndarray, bits: int) -> np.ndarray:
    """Parities of the shingles dealt to ``bits`` places, packed."""
    at = (_mix(found) % np.uint64(bits)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8))


def wide_sketch(found: np.ndarray) -> bytes:
    """The sketch of twice the bits that the set's size asks for; its halves fold to that of as many."""
    bits = 8
    while bits < min(SKETCH * len(found), SKETCH_BITS):
        bits *= 2
    return sketch(found, 2 * bits).tobytes()


def fold(wide: bytes, length: int) -> np.ndarray:
    """The sketch of ``length`` bytes, as one or more 64-bit words."""
    out = np.frombuffer(wide, np.uint8)
    out = out if len(out) == length else out[:length] ^ out[length:]
    return np.pad(out, (0, -length % 8)).view(np.uint64)


def fingerprint(found: np.ndarray) -> int:
    """The signed SimHash of the set: the bits that over half of its hashes have."""
    votes = np.zeros(64, np.int64)
    for at in range(0, len(found), _PAIRS):
        votes += np.unpackbits(found[at : at + _PAIRS].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > len(found)).tobytes(), "big", signed=True)


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, node, n, fp, wide, keys) of each row of ``docs`` (doc_id, text)."""
    text_batches(docs.sparkSession)
    share = min(1.0, SAMPLE_DOCS / max(1, docs.count()))
    sample = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000) + 1).select("text")

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 1000):
                found = [shingles(text).view(np.int64) for text in batch["text"].iloc[at : at + 1000]]
                yield pd.DataFrame({"shingle": np.concatenate(found)})

    seen = sample.mapInPandas(each, "shingle long").groupBy("shingle").agg(F.count(F.lit(1)).alias("times")).filter(F.col("times") >= FREQUENT_DOCS)
    known = seen.orderBy(F.desc("times"), "shingle").limit(FREQUENT).toArrow().to_pandas()
    frequent = known["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(frequent)
    shared = docs.sparkSession.sparkContext.broadcast((frequent[order], known["times"].to_numpy(np.int64)[order]))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 1000):
                own = batch.iloc[at : at + 1000]
                sets = [shingles(t) for t in own["text"]]
                columns = {"node": [set_id(s) for s in sets], "n": [len(s) for s in sets], "fp": [fingerprint(s) for s in sets], "wide": [wide_sketch(s) for s in sets], "keys": [keys(s, *shared.value) for s in sets]}
                yield pd.DataFrame({"doc_id": own["doc_id"].to_numpy(), **columns})

    return docs.select("doc_id", "text").mapInPandas(work, "doc_id long, node long, n int, fp long, wide binary, keys array<long>")


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sets = [shingles(t) for t in batch["text"]]
        own = [(n, s.view(np.int64)) for n, s in zip(batch["node"], sets, strict=True) if set_id(s) == n]
        yield pd.DataFrame(own, columns=["node", "held"])


def _verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        near = [similar(x, y) for x, y in zip(batch["x"], batch["y"], strict=True)]
        yield batch.loc[near, ["a", "b"]]


def allowed(n: np.ndarray, wide: list[bytes], i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs (i, j) of sets of ``n`` shingles may be similar by sizes and sketches, and the bits that those differ in."""
    top, bottom = SIMILARITY
    apart = (bottom - top) * (n[i] + n[j]) // (bottom + top)
    lengths = np.array([len(w) for w in wide], np.int64)
    small = np.minimum(lengths[i], lengths[j])
    fit = (np.abs(n[i] - n[j]) <= apart) & (np.maximum(lengths[i], lengths[j]) <= 2 * small)
    differ = np.zeros(len(i), np.int64)
    for length in np.unique(small[fit]).tolist():
        own = np.nonzero(fit & (small == length))[0]
        rows, at = np.unique(np.concatenate([i[own], j[own]]), return_inverse=True)
        bits = np.array([fold(wide[r], length) for r in rows.tolist()])
        x, y = at[: len(own)], at[len(own) :]
        step = max(1, 8 * _PAIRS // bits.shape[1])
        for a in range(0, len(own), step):
            differ[own[a : a + step]] = np.bitwise_count(bits[x[a : a + step]] ^ bits[y[a : a + step]]).sum(axis=1)
    return fit & (differ <= apart), differ


def _allowed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs whose sizes and sketches allow the similarity."""
    for batch in batches:
        k = np.arange(len(batch))
        near, _ = allowed(np.concatenate([batch["m"], batch["n"]]).astype(np.int64), [*batch["x"], *batch["y"]], k, k + len(batch))
        yield batch.loc[near, ["a", "b"]]


def _groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The batches of sorted rows, cut where a (key, i, j) ends."""
    held = []
    for batch in batches:
        if not len(batch):
            continue
        last = batch.iloc[-1]
        open_from = int(((batch["key"] != last["key"]) | (batch["i"] != last["i"]) | (batch["j"] != last["j"])).to_numpy().nonzero()[0].max(initial=-1)) + 1
        if open_from or held and tuple(held[-1][["key", "i", "j"]].iloc[-1]) != tuple(last[["key", "i", "j"]]):
            yield pd.concat([*held, batch.iloc[:open_from]], ignore_index=True)
            held = []
        held.append(batch.iloc[open_from:])
    if held:
        yield pd.concat(held, ignore_index=True)


def nearest_pairs(rows: pd.DataFrame, most: int) -> pd.DataFrame:
    """(key, i, j, a, b, more): for each row of each (key, i, j) its ``most`` nearest of those in other components
    that the sketches allow; more: whether some of the group's pairs were left out."""
    n, wide, node, root, h = rows["n"].to_numpy(np.int64), rows["wide"].tolist(), rows["node"].to_numpy(), rows["root"].to_numpy(), rows["h"].to_numpy()
    where = rows[["key", "i", "j"]].to_numpy()
    starts = np.concatenate([[0], np.nonzero((where[1:] != where[:-1]).any(axis=1))[0] + 1, [len(rows)]])
    group = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    ahead = starts[group + 1] - np.arange(len(rows)) - 1  # rows of the group after each
    within = rows["i"].to_numpy() == rows["j"].to_numpy()
    best = np.zeros((3, 0), np.int64)  # row, other row, bits apart
    more = np.zeros(len(starts) - 1, bool)
    ends = np.cumsum(ahead)
    at = 0
    while at < len(rows):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _PAIRS, "right")))
        i = np.repeat(np.arange(at, to), ahead[at:to])
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(ahead[at:to]) - ahead[at:to], ahead[at:to])
        apart = (root[i] != root[j]) & (within[i] | (h[i] != h[j]))
        i, j = i[apart], j[apart]
        near, differ = allowed(n, wide, i, j)
        i, j, differ = i[near], j[near], differ[near]
        best = np.concatenate([best, [i, j, differ], [j, i, differ]], axis=1)
        best = best[:, np.lexsort((best[1], best[2], best[0]))]
        place = np.arange(best.shape[1])
        rank = place - np.maximum.accumulate(np.where(np.diff(best[0], prepend=-1) != 0, place, 0)) if best.shape[1] else place
        more[group[best[0, rank >= most]]] = True
        best = best[:, rank < most]
        at = to
    source, other, _ = best
    return pd.DataFrame({**{c: rows[c].to_numpy()[source] for c in ("key", "i", "j")}, "a": np.minimum(node[source], node[other]), "b": np.maximum(node[source], node[other]), "more": more[group[source]]})


def links(base: DataFrame, docs: DataFrame) -> DataFrame:
    """(a, b): links of sets whose closure is that of all pairs at the similarity.

    ``base`` has (doc_id, node, n, fp, wide, keys) of ``docs`` (doc_id, text); node names a set.
    """
    of_key = base.select("node", F.col("n").cast("long").alias("n"), F.posexplode("keys").alias("p", "key"))
    half = F.shiftright("node", 32).cast("int")  # enough to tell that a key's sets differ
    # at place p of n, n - p shingles can be common at most; least: the smallest set that can be the smaller of a pair by this key
    top, bottom = SIMILARITY
    room = (bottom + top) * (F.col("n") - F.col("p"))
    least = F.min(F.when(room >= 2 * top * F.col("n"), F.col("n"))).alias("least")
    shared = written(of_key.groupBy("key").agg(F.min(half).alias("low"), F.max(half).alias("high"), least).filter("low <> high and least is not null").select("key", "least"))
    met = written(of_key.join(sized_broadcast(shared), "key").filter(room >= top * (F.col("n") + F.col("least"))).select("node", "key").distinct())
    discard(shared)
    used = written(met.select("node").distinct())
    drawn = written(base.join(sized_broadcast(used), "node").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("fp").alias("fp"), F.first("wide").alias("wide")))

    def verify(pairs: DataFrame) -> DataFrame:
        """Those of ``pairs`` (a, b) at the similarity."""
        x, y = drawn.select(F.col("node").alias("a"), F.col("n").alias("m"), F.col("wide").alias("x")), drawn.select(F.col("node").alias("b"), "n", F.col("wide").alias("y"))
        pairs = written(pairs.join(x, "a").join(y, "b").mapInPandas(_allowed, "a long, b long"))
        ends = written(pairs.select("a").union(pairs.select("b")).toDF("node").distinct())
        holders = written(drawn.select("node", "doc_id").join(sized_broadcast(ends), "node"))
        sets = docs.join(sized_broadcast(holders), "doc_id").select("node", "text").mapInPandas(_sets, "node long, held array<long>").dropDuplicates(["node"])
        sets = written(sets)
        x, y = sets.select(F.col("node").alias("a"), F.col("held").alias("x")), sets.select(F.col("node").alias("b"), F.col("held").alias("y"))
        near = written(pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInPandas(_verified, "a long, b long"))
        discard(pairs, ends, holders, sets)
        return near

    def split(rows: DataFrame, roots: DataFrame, *by: str) -> DataFrame:
        """``rows`` (with node) whose group ``by`` lies in more than one component, with root."""
        placed = rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        several = placed.groupBy(*by).agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select(*by)
        return written(placed.join(several, [*by]))

    one_fp = written(drawn.groupBy("fp").agg(F.min("node").alias("node")))
    same_fp = drawn.select("fp", F.col("node").alias("b")).join(one_fp.withColumnRenamed("node", "a"), "fp").filter("a <> b").select("a", "b")
    edges = verify(simhash_segments.links(one_fp).unionByName(same_fp))
    open_keys, roots = met, written(components(edges))
    for k in range(HUBS):
        open_keys = split(open_keys.select("key", "node"), roots, "key")
        hub = open_keys.groupBy("key").agg(F.min_by(F.struct("node", "root"), F.xxhash64("node", F.lit(k))).alias("hub"))
        stars = open_keys.join(hub, "key").filter("root <> hub.root").select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b"))
        edges = written(edges.unionByName(verify(written(stars.distinct()))))
        roots = written(components(edges))

    open_keys = split(open_keys.select("key", "node"), roots, "key")
    alike = open_keys.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.struct(F.bit_xor(F.xxhash64("node")), F.bit_xor(F.xxhash64("node", F.lit(1)))).alias("mark"))
    once = alike.groupBy("members", "mark").agg(F.min("key").alias("key")).select("key", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))
    dealt = open_keys.join(once, "key").select("key", "node", "blocks", F.pmod(F.xxhash64("node", F.lit("block")), F.col("blocks")).cast("int").alias("h")).withColumn("g", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    groups = written(dealt.select("key", F.least("h", "g").alias("i"), F.greatest("h", "g").alias("j"), "h", "node"))
    tried, most = None, 1
    while True:
        rows = split(groups, roots, "key", "i", "j").join(drawn.select("node", "n", "wide"), "node").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "node")
        found = written(rows.mapInPandas(lambda it, most=most: (nearest_pairs(own, most) for own in _groups(it)), "key long, i int, j int, a long, b long, more boolean"))
        pairs = found.select("a", "b").distinct()
        new = written(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"))
        if new.limit(1).count():
            near = verify(new)
            before, tried = tried, new if tried is None else written(tried.unionByName(new))
            if before is not None:
                discard(before, new)
            if near.limit(1).count():
                old, edges = (edges, roots), written(edges.unionByName(near))
                roots = written(components(edges))
                discard(near, *old)
        left = written(found.filter("more").select("key", "i", "j").distinct())
        discard(found)
        if not left.limit(1).count():
            return edges
        before, groups = groups, written(groups.join(left, ["key", "i", "j"], "left_semi"))
        discard(before, left)
        most *= 8


def near_copies(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id and component_id, the smallest doc_id of its near copies."""
    base = written(keyed(docs))
    named = base.filter("doc_id is not null")
    edges = links(named, docs.filter("doc_id is not null").select("doc_id", "text"))
    repeated = named.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a <> b").select("doc_id", "a")
    if repeated.limit(1).count():  # a doc_id on rows with different texts joins their sets
        edges = edges.unionByName(named.join(repeated, "doc_id").select("a", F.col("node").alias("b")).filter("a <> b"))
    roots = components(edges)
    nodes = named.groupBy("node").agg(F.min("doc_id").alias("least")).join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    nodes = written(nodes)
    least = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    of_node = written(nodes.join(least, "root").select("node", "component_id"))
    return base.select("doc_id", "node").join(of_node, "node", "left").select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
