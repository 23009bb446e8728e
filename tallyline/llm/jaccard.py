"""N-gram Jaccard join with token-combination prefixes.

Tokens are 5-word shingles, told apart by 64-bit hashes. Two sets of similarity t or more share nearly all tokens of the larger
one, so a prefix of each set in one global order suffices to meet. Rare tokens come first and are indexed alone. If a set has too few
of them, its prefix goes on into the frequent tokens, by frequency: these are dealt into classes, and every combination of k tokens of
a class is indexed, k growing with the frequency. n tokens of a class in a prefix yield combinations that survive n - k missing
tokens, so the prefix is extended until rare tokens and classes together withstand all the tokens a partner may lack. Candidates that
meet in the index are verified on the whole sets.

Sets that are alike are one node; nodes, not rows, are indexed. Entries of rare tokens are short. Entries of combinations may hold a
large group of near copies, so they are never joined with themselves: first all nodes of an entry are verified against its most
central node, which joins most of a group; components form; then only nodes outside an entry's main component are compared with the
rest of it, block by block, so a large group never emits all its pairs, and none is lost. Links lie within components, so at last
the nodes of each component are compared with each other on their whole sets, in blocks that pass on only each node's number of links.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.common import comparable, cut, discard, scratch
from tallyline.llm.words import in_turn, steps

SHINGLE = 5
#: A token is frequent in at least this many nodes, if it is among the TABLE most frequent; so there are at most TABLE.
FREQUENT, TABLE = 12, 1 << 20
#: Frequent tokens are combined by pairs; from this many nodes on, by threes.
BY_THREES = 4096
#: Sets below this size index frequent tokens alone. Above, sizes between two powers of two are a level, and a level whose least size is
#: s deals tokens into s / PAIR_CLASS classes of pairs and s / THREE_CLASS classes of threes. Every set of the level then has enough
#: tokens: s - s / PAIR_CLASS - 2 * s / THREE_CLASS are at least as many as a partner may lack, and one.
PAIRED, PAIR_CLASS, THREE_CLASS = 16, 4, 8
#: Tokens that a task sorts before it passes them on, and tokens that are counted in one group.
COUNTED, COUNT_GROUP = 2_000_000, 4_000_000
#: Bytes of text that a task hashes at a time.
STEP = 1_000_000
#: Neighbours are first compared in one of so many index entries.
PART = 16
#: Nodes of an entry are compared in blocks of this many.
BLOCK = 1024
#: Rows of short entries that are compared in one group, and pairs that a task holds at a time.
TOGETHER, HELD = 12_000, 250_000
#: Links are counted between blocks of about this many nodes and tokens.
COUNT_NODES, COUNT_TOKENS = 1024, 1_000_000
#: Cells of the bitmap by which rows that are no candidates are left out before a shuffle.
BITMAP = 1 << 23

U = np.uint64
#: Entries of rare tokens are negative and precede those of combinations.
SIGN = U(1 << 63)
_POWERS: list[np.ndarray] = []


def _mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers, one to one."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of an odd base modulo 2^64 and of its inverse."""
    if not _POWERS or len(_POWERS[0]) < n:
        most = max(n, 1 << 20)
        base = 0x9E3779B97F4A7C15
        inverse = pow(base, -1, 1 << 64)
        _POWERS[:] = [np.concatenate([[U(1)], np.cumprod(np.full(most - 1, U(b)))]) for b in (base, inverse)]
    return _POWERS[0][:n], _POWERS[1][:n]


def _byte_table() -> tuple[np.ndarray, np.ndarray]:
    table = _mix(np.arange(1, 257, dtype=U))
    table[65:91] = table[97:123]  # A-Z as a-z
    gap = np.zeros(256, bool)
    gap[[0x20, *range(0x09, 0x0E)]] = True
    return table, gap


_BYTES, _GAPS = _byte_table()


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text (no nulls): of every five words, or of all words if there are fewer."""
    lengths = np.asarray(pc.binary_length(texts).to_numpy(zero_copy_only=False), np.int64)
    raw = np.frombuffer(b" ".join([*(t.as_buffer() for t in texts.cast(pa.binary())), b""]) if len(texts) else b"", np.uint8)
    at = np.cumsum(lengths + 1) - lengths - 1
    power, inverse = _powers(len(raw) + 1)
    gap = _GAPS[raw]
    edge = np.diff(np.concatenate([[True], gap, [True]]).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    sums = np.concatenate([[U(0)], np.cumsum(_BYTES[raw] * power[:-1])])
    word = _mix((sums[end] - sums[start]) * inverse[start] ^ (end - start).astype(U))
    first = np.searchsorted(start, at)
    last = np.append(first[1:], len(word))
    mixed = np.zeros(max(0, len(word) - SHINGLE + 1), U)
    for k in range(SHINGLE):
        mixed = _mix(mixed + word[k : k + len(mixed)] + U(k + 1))
    out = []
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        if b - a >= SHINGLE:
            out.append(np.unique(mixed[a : b - SHINGLE + 1]))
        elif b > a:
            h = np.full(1, b - a, U)
            for k in range(a, b):
                h = _mix(h * U(3) + word[k : k + 1])
            out.append(h)
        else:
            out.append(np.empty(0, U))
    return out


def node_of(tokens: np.ndarray) -> int:
    """One 64-bit name for a set; sets that are alike share it."""
    return int((_mix(tokens ^ U(0x5851F42D4C957F2D)).sum(dtype=U) + U(len(tokens))).view(np.int64)) if len(tokens) else 0


def missing(n: int, percent: int) -> int:
    """How many of a set's n tokens a partner may lack."""
    return n - -(-percent * n // 100)


def _often(tokens: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens are frequent, and where each stands among ``frequent`` (sorted upper halves)."""
    upper = (tokens >> U(32)).astype(np.uint32)
    if not len(frequent):
        return np.zeros(len(tokens), bool), np.zeros(len(tokens), np.int64)
    place = np.minimum(np.searchsorted(frequent, upper), len(frequent) - 1)
    return frequent[place] == upper, place


def rare_signatures(tokens: np.ndarray, frequent: np.ndarray, percent: int) -> tuple[np.ndarray, bool]:
    """The rare tokens of a set's prefix, and whether the prefix goes on into the frequent ones. Tokens are sorted."""
    need = missing(len(tokens), percent) + 1 if len(tokens) else 0
    rare = tokens[~_often(tokens, frequent)[0]]
    return (rare[:need] | SIGN).view(np.int64), len(rare) < need


def level_of(n: int) -> int:
    """0 for sets below PAIRED tokens, then 1, 2, ... as sizes double."""
    return max(0, int(n).bit_length() - PAIRED.bit_length() + 1)


def _combined(tokens: np.ndarray, group: np.ndarray, k: int, salt: np.uint64) -> list[np.ndarray]:
    """A hash of every combination of ``k`` (2 or 3) tokens of like group; groups lie together."""
    out, size = [], len(tokens)
    for one in range(1, size):
        same = group[one:] == group[:-one]
        if not same.any():
            break
        pair = _mix(_mix(tokens[:-one] + salt) + tokens[one:])
        if k == 2:
            out.append(pair[same])
            continue
        for two in range(1, size - one):
            third = group[one + two :] == group[: size - one - two]
            if not third.any():
                break
            out.append(_mix(pair[: size - one - two][third] + tokens[one + two :][third]))
    return out


def heavy_signatures(tokens: np.ndarray, frequent: np.ndarray, threes: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """Entries of the frequent tokens of one set's prefix, and the number of its frequent tokens. ``threes`` tells which combine by threes.

    Two sets that share no rare token meet here on the level of the smaller one. A set emits combinations for its own level and, for
    smaller partners, for the level below if such a partner may lie there. Frequent tokens go by frequency class, then by hash.
    """
    n = len(tokens)
    often, place = _often(tokens, frequent)
    heavy, three = tokens[often], threes[place[often]]
    order = np.argsort(three, kind="stable")
    heavy, three = heavy[order], three[order]
    rare, out = n - len(heavy), []
    smallest = -(-percent * n // 100)
    for level in {level_of(n), level_of(smallest)}:
        partner = max(smallest, PAIRED << (level - 1) if level else 1)
        need = n + 1 - -(-percent * (n + partner) // (100 + percent)) - rare
        if need <= 0:
            continue
        salt = U((level + 1) * 0xD1342543DE82EF95 & 0xFFFFFFFFFFFFFFFF)
        if level == 0:
            out.append(_mix(heavy[:need] ^ salt))
            continue
        least = PAIRED << (level - 1)
        spread = _mix(heavy ^ salt)
        cls = np.where(three, (spread % U(least // THREE_CLASS)).astype(np.int64) - least, (spread % U(least // PAIR_CLASS)).astype(np.int64))
        by_class = np.argsort(cls, kind="stable")
        first = np.concatenate([[True], np.diff(cls[by_class]) != 0])
        at = np.arange(len(cls))
        rank = np.empty(len(cls), np.int64)  # a token's place in its class
        rank[by_class] = at - np.maximum.accumulate(np.where(first, at, 0))
        held = np.cumsum(rank >= np.where(three, 2, 1))  # missing tokens that the combinations withstand so far
        size = int(np.searchsorted(held, need)) + 1
        used = by_class[by_class < size]
        by_three = three[used]
        out += _combined(heavy[used[~by_three]], cls[used[~by_three]], 2, salt) + _combined(heavy[used[by_three]], cls[used[by_three]], 3, salt)
    return (np.unique(np.concatenate(out) & ~SIGN) if out else np.empty(0, U)).view(np.int64), len(heavy)


def bitmap_of(tokens: np.ndarray) -> np.ndarray:
    """Bitmap of a set, of two to four bits a token, as 64-bit words; a power of two of them, so that one folds onto another."""
    size = max(64, 1 << int(2 * len(tokens) - 1).bit_length()) if len(tokens) else 64
    flags = np.zeros(size, bool)
    flags[(tokens % U(size)).astype(np.int64)] = True
    return np.packbits(flags, bitorder="little").view(np.int64)


def _packed(sorted_halves: np.ndarray) -> bytes:
    """Sorted 32-bit numbers as compressed differences, byte by byte plane."""
    steps_ = np.diff(sorted_halves, prepend=np.uint32(0)).astype("<u4")
    return zlib.compress(steps_.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpacked(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(blob), np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32)


def new_nodes(sets: list[np.ndarray], seen: set[int]) -> list[np.ndarray]:
    """The sets that a task has not met before, so that copies of a text count about once a task; ``seen`` holds 8 bytes a node."""
    out = []
    for s in sets:
        if len(s) and (node := node_of(s)) not in seen:
            seen.add(node)
            out.append(s)
    return out


def frequent_tokens(docs: DataFrame, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted upper halves of the hashes of frequent tokens, at most TABLE of them, and which of them combine by threes.

    Every token of every document is counted; ``total`` is about how many there are. Tasks sort the upper halves of their tokens'
    hashes and pass them on by ranges, packed to about a byte and a half each; each range, of about COUNT_GROUP tokens, is then
    counted on its own. Where two tokens share an upper half, both count as the sum; that moves a token in the index order, and
    never decides whether a pair is found.
    """
    parts = total // COUNT_GROUP + 1
    edges = (np.arange(1, parts) * 2**32 // parts).astype(np.uint32)

    @in_turn("jaccard")
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen: set[int] = set()
        count = 0

        def passed() -> pa.RecordBatch:
            halves = np.sort(np.concatenate(held) if held else np.empty(0, np.uint32))
            pieces = np.split(halves, np.searchsorted(halves, edges))
            rows = [(i, _packed(x)) for i, x in enumerate(pieces) if len(x)]
            return pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())], ["part", "blob"])

        for batch in batches:
            for part in steps(batch, 0, STEP):
                sets = new_nodes(shingle_sets(part.column(0)), seen)
                held += [(x >> U(32)).astype(np.uint32) for x in sets]
                count += sum(map(len, sets))
                if count > COUNTED:
                    yield passed()
                    held, count = [], 0
        yield passed()

    def tally(rows: pd.DataFrame) -> pd.DataFrame:
        token, n = np.unique(np.concatenate([_unpacked(x) for x in rows.blob]), return_counts=True)
        often = n >= FREQUENT
        return pd.DataFrame({"token": token[often].astype(np.int64), "n": n[often].astype(np.int64)})

    counts = docs.select("text").mapInArrow(deal, "part int, blob binary").groupBy("part").applyInPandas(tally, "token long, n long")
    found = counts.orderBy(F.desc("n"), "token").limit(TABLE).toPandas().sort_values("token")
    return found["token"].to_numpy(np.int64).astype(np.uint32), found["n"].to_numpy() >= BY_THREES


def row_key() -> Column:
    """A name of a row's doc_id and text, never null; rows that are alike in both share it."""
    return F.xxhash64(F.col("doc_id").cast("long"), "text")


def described(docs: DataFrame) -> DataFrame:
    """key, doc_id, n, node, bits for each row."""

    @in_turn("jaccard")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, 2, STEP):
                sets = shingle_sets(part.column(2))
                bits = [bitmap_of(s) for s in sets]
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in bits])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(offsets, np.concatenate(bits))
                n, node = pa.array([len(s) for s in sets], pa.int64()), pa.array([node_of(s) for s in sets], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), n, node, lists], ["key", "doc_id", "n", "node", "bits"])

    return docs.select("key", "doc_id", "text").mapInArrow(run, "key long, doc_id long, n long, node long, bits array<long>")


def rare_entries(docs: DataFrame, frequent: np.ndarray, percent: int) -> DataFrame:
    """sig, node, n, goes_on: a row for each rare token of each prefix, and one more (its node for sig) for a prefix that goes on.

    Rows that are alike in text count about once a task.
    """
    known = docs.sparkSession.sparkContext.broadcast(frequent)  # at most TABLE numbers

    @in_turn("jaccard")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in steps(batch, 0, STEP):
                sets = new_nodes(shingle_sets(part.column(0)), seen)
                found = [rare_signatures(s, known.value, percent) for s in sets]
                names = np.array([node_of(s) for s in sets], np.int64)
                count, more = np.array([len(s) for s, _ in found], np.int64), np.array([x for _, x in found], bool)
                sizes = np.array([len(s) for s in sets], np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([*(s for s, _ in found), names[more]]).astype(np.int64)), pa.array(np.concatenate([np.repeat(names, count), names[more]])),
                     pa.array(np.concatenate([np.repeat(sizes, count), sizes[more]])), pa.array(np.arange(count.sum() + more.sum()) >= count.sum())],
                    ["sig", "node", "n", "goes_on"],
                )

    return docs.select("text").mapInArrow(run, "sig long, node long, n int, goes_on boolean")


def heavy_entries(sets: DataFrame, frequent: np.ndarray, threes: np.ndarray, percent: int) -> DataFrame:
    """sig, node, n, h: a row for each combination of frequent tokens of each set (node, tokens); h is the number of its frequent tokens."""
    known = sets.sparkSession.sparkContext.broadcast((frequent, threes))

    @in_turn("jaccard")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(1).offsets.to_numpy()
            flat = batch.column(1).values.to_numpy(zero_copy_only=False).view(U)
            found = [heavy_signatures(flat[a:b], *known.value, percent) for a, b in zip(at[:-1], at[1:], strict=True)]
            count = [len(s) for s, _ in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([s for s, _ in found])), pa.array(np.repeat(batch.column(0).to_numpy(), count)), pa.array(np.repeat(np.diff(at), count).astype(np.int32)),
                 pa.array(np.repeat(np.array([h for _, h in found], np.int32), count))], ["sig", "node", "n", "h"]
            )

    return sets.select("node", "tokens").mapInArrow(run, "sig long, node long, n int, h int")


def token_sets(docs: DataFrame) -> DataFrame:
    """node and its tokens for each row."""

    @in_turn("jaccard")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in steps(batch, 0, STEP):
                sets = shingle_sets(part.column(0))
                offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                values = np.concatenate(sets).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([node_of(s) for s in sets], pa.int64()), pa.ListArray.from_arrays(offsets, values)], ["node", "tokens"]
                )

    return docs.select("text").mapInArrow(run, "node long, tokens array<long>")


def only_keys(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose key is in ``keys``. A bitmap of fixed size, broadcast, keeps most others out of the shuffle."""
    cell = F.pmod(F.xxhash64("key"), F.lit(BITMAP))
    bits = keys.select(cell.alias("cell")).distinct()
    bits = bits.groupBy(F.floor(F.col("cell") / 64).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(cell % 64 as int))")).alias("bits"))
    there = docs.withColumn("cell_", cell)
    there = there.join(F.broadcast(bits), F.floor(F.col("cell_") / 64) == F.col("at"))
    there = there.where(F.expr("shiftrightunsigned(bits, cast(cell_ % 64 as int)) & 1 = 1")).select(*docs.columns)
    return there.join(keys, "key", "left_semi")


def _enough(shared: Column, sizes: Column, percent: int) -> Column:
    return 100 * shared >= percent * (sizes - shared)


def possible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose bitmaps leave it open that they are alike enough.

    A bit of one set that the other lacks stands for at least one token that the other lacks; the longer bitmap is folded first.
    """
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("bits").alias(f"b{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    size = F.least(F.size("ba"), F.size("bb"))

    def fitted(x: str) -> Column:
        half = F.zip_with(F.slice(x, F.lit(1), size), F.slice(x, size + 1, size), lambda p, q: p.bitwiseOR(q))
        return F.when(F.size(x) == 2 * size, half).otherwise(F.col(x))

    both = both.select("a", "b", "na", "nb", fitted("ba").alias("ba"), fitted("bb").alias("bb"), (F.greatest(F.size("ba"), F.size("bb")) <= 2 * size).alias("fit"))
    lacks = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseAND(F.bitwise_not(q)))), F.lit(0), lambda s, v: s + v)
    shared = F.when(F.col("fit"), F.least(F.col("na") - lacks("ba", "bb"), F.col("nb") - lacks("bb", "ba"))).otherwise(F.least("na", "nb"))
    return both.where(_enough(shared, F.col("na") + F.col("nb"), percent)).select("a", "b")


def sets_of(named: DataFrame, docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node and its tokens for the nodes named (distinct). Only texts that are needed are shuffled."""
    wanted = named.join(nodes, "node").select("key")
    found = token_sets(only_keys(docs, wanted)).join(named, "node", "left_semi")
    return cut(found.groupBy("node").agg(F.first("tokens").alias("tokens")), "sets")


def verified(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b), of those given, that are alike enough by their whole sets."""
    pairs = cut(possible(pairs, nodes, percent), "possible")
    named = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    sets = sets_of(named, docs, nodes)
    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("tb"))
    both = pairs.join(left, "a").join(right, "b")
    both = both.select("a", "b", (F.size("ta") + F.size("tb")).alias("sizes"), F.size(F.array_intersect("ta", "tb")).alias("shared"))
    links = cut(both.where(_enough(F.col("shared"), F.col("sizes"), percent)).select("a", "b"), "links")
    discard(pairs, sets)
    return links


def compare_blocks(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Pairs (a, b) of a guest and a resident of like entry that differ in component and whose sizes and bitmaps leave them open.

    Two guests are compared in one direction. Two nodes may meet in many entries; the pair leaves only the first of them, by the
    nodes' sorted lists of entries: one of a rare token if they share such, and only if not, h bounds what they share.
    """
    rows = rows.sort_values("sig", kind="stable", ignore_index=True)
    sig, node, n, h, component, minor = (rows[c].to_numpy() for c in ("sig", "node", "n", "h", "component", "minor"))
    n, h = n.astype(np.int64), h.astype(np.int64)
    guest = rows.guest.to_numpy()
    guests, residents = np.flatnonzero(guest), np.flatnonzero(~guest)
    first = np.searchsorted(sig[residents], sig[guests])
    count = np.searchsorted(sig[residents], sig[guests], side="right") - first
    ends = np.cumsum(count)
    bits = [np.asarray(x, np.int64).view(U) for x in rows.bits]
    width = np.array([len(x) for x in bits])
    sigs = list(map(np.asarray, rows.sigs))
    found_a, found_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    start = 0
    while start < len(guests):
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + HELD, side="right")))
        own, their = guests[start:stop], count[start:stop]
        g = np.repeat(own, their)
        base = np.repeat(first[start:stop] - (np.cumsum(their) - their), their)
        r = residents[base + np.arange(len(g))]
        start = stop
        most = np.minimum(h[g], h[r])
        ok = (component[g] != component[r]) & (~minor[r] | (node[g] < node[r])) & (100 * most >= percent * (n[g] + n[r] - most))
        ok &= 100 * np.minimum(n[g], n[r]) >= percent * np.maximum(n[g], n[r])
        g, r = g[ok], r[ok]
        for wide in np.unique(np.stack([width[g], width[r]]), axis=1).T if len(g) else []:
            here = np.flatnonzero((width[g] == wide[0]) & (width[r] == wide[1]))
            if wide.max() > 2 * wide.min():
                continue  # sets of such sizes are never alike enough
            narrow = int(wide.min())
            for k in range(0, len(here), max(1, HELD // narrow)):
                i, j = g[here[k : k + max(1, HELD // narrow)]], r[here[k : k + max(1, HELD // narrow)]]
                x, y = np.stack([bits[v] for v in i]), np.stack([bits[v] for v in j])
                x, y = (z if z.shape[1] == narrow else z[:, :narrow] | z[:, narrow:] for z in (x, y))
                both = np.minimum(n[i] - np.bitwise_count(x & ~y).sum(axis=1, dtype=np.int64), n[j] - np.bitwise_count(y & ~x).sum(axis=1, dtype=np.int64))
                open_ = 100 * both >= percent * (n[i] + n[j] - both)
                for p, q in zip(i[open_].tolist(), j[open_].tolist(), strict=True):
                    if np.intersect1d(sigs[p], sigs[q], assume_unique=True)[0] == sig[p]:
                        found_a.append(node[p : p + 1])
                        found_b.append(node[q : q + 1])
    x, y = np.concatenate(found_a), np.concatenate(found_b)
    return pd.DataFrame({"a": np.minimum(x, y), "b": np.maximum(x, y)})


def pairs_in_blocks(entries: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) across components within entries (sig, node, n, h, component) whose sizes and bitmaps leave them open.

    The component with most nodes in an entry is its main one. Every node outside it is a guest, compared with all nodes of the entry.
    Nodes and guests are dealt into blocks; each pair of blocks is a group of its own, compared in numpy, so no task sees a whole large
    entry and only pairs that stay open leave it. Short entries share groups.
    """
    by_component = entries.groupBy("sig", "component").agg(F.count("*").alias("size"))
    main = by_component.groupBy("sig").agg(
        F.sum("size").alias("size"), F.max(F.struct("size", "component")).alias("main"), F.count("*").alias("n_components")
    )
    main = main.where("n_components > 1").select("sig", "size", F.col("main.component").alias("main"), (F.col("size") - F.col("main.size")).alias("guests"))
    rows = entries.join(main, "sig").withColumn("minor", F.col("component") != F.col("main"))
    blocks, guest_blocks = (F.ceil(F.col(c) / BLOCK).cast("int") for c in ("size", "guests"))
    rows = rows.select("sig", "node", "n", "h", "component", "minor", blocks.alias("k"), guest_blocks.alias("g"))
    rows = cut(rows, "rest")
    if rows.isEmpty():
        return rows.select(F.col("node").alias("a"), F.col("node").alias("b"))
    lists = rows.groupBy("node").agg(F.sort_array(F.collect_set("sig")).alias("sigs"))  # a node's own entries, as many as its prefix has
    own = lambda k: F.pmod(F.xxhash64("node"), F.col(k)).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), F.col(k) - 1))
    residents = rows.select("*", F.lit(False).alias("guest"), own("k").alias("i"), every("g").alias("j"))
    guests = rows.where("minor").select("*", F.lit(True).alias("guest"), every("k").alias("i"), own("g").alias("j"))
    groups = rows.count() // TOGETHER + 1
    large = F.col("k") > 1
    dealt = residents.unionByName(guests).withColumn("large", large).withColumn("group", F.when(large, F.col("sig")).otherwise(F.pmod(F.xxhash64("sig"), F.lit(groups))))
    dealt = dealt.join(nodes.select("node", "bits").join(lists, "node"), "node")
    dealt = dealt.select("large", "group", "i", "j", "sig", "node", "n", "h", "component", "minor", "guest", "bits", "sigs")
    return dealt.groupBy("large", "group", "i", "j").applyInPandas(lambda g: compare_blocks(g, percent), "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """node and component (its least node) for all nodes of the links (a, b).

    Each round every node takes the least label among its neighbours and then that label's label; rounds end when none changes.
    """
    edges = cut(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = cut(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "labels")
    while True:
        near = edges.join(labels.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        new = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("via"))
        jump = labels.select(F.col("node").alias("via"), F.col("component").alias("far"))
        new = cut(new.join(jump, "via").select("node", "old", F.least("via", "far").alias("component")), "labels")
        done = new.where("old <> component").isEmpty()
        discard(labels)
        labels = new
        if done:
            discard(edges)
            return labels.select("node", "component")


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many tokens each set on the left shares with each on the right; exact."""
    sizes = [len(x) for x in (*left, *right)]
    owner = np.repeat(np.arange(len(sizes)), sizes)
    _, column, count = np.unique(np.concatenate([*left, *right]), return_inverse=True, return_counts=True)
    twice = count > 1  # a token of one set alone is shared with none
    place = np.cumsum(twice) - 1
    owner, column = owner[twice[column]], place[column[twice[column]]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(left), len(right)), np.int64)
    width = 4096
    for k in range(0, int(twice.sum()), width):
        a, b = np.searchsorted(column, [k, k + width])
        there = np.zeros((len(sizes), min(width, int(twice.sum()) - k)), np.float32)
        there[owner[a:b], column[a:b] - k] = 1
        out += (there[: len(left)] @ there[len(left) :].T).astype(np.int64)
    return out


def count_links(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """node and its number of links to nodes of the same component, between two blocks or within one."""
    low, high = rows.low.iat[0], rows.high.iat[0]
    block, tokens, node = rows.block.to_numpy(), [np.asarray(x, np.int64) for x in rows.tokens], rows.node.to_numpy()
    n, found = np.array([len(x) for x in tokens], np.int64), np.zeros(len(rows), np.int64)
    order = np.argsort(rows.component.to_numpy(), kind="stable")
    edges = np.flatnonzero(np.diff(rows.component.to_numpy()[order])) + 1
    for at in np.split(order, edges):
        left, right = at[block[at] == low], at[block[at] == high]
        if not len(left) or not len(right):
            continue
        shared = shared_counts([tokens[i] for i in left], [tokens[i] for i in right])
        linked = 100 * shared >= percent * (n[left][:, None] + n[right][None, :] - shared)
        if low == high:
            np.fill_diagonal(linked, False)
        else:
            found[right] += linked.sum(axis=0)
        found[left] += linked.sum(axis=1)
    return pd.DataFrame({"node": node, "n_links": found})


def degrees(label: DataFrame, docs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """node and n_links for all nodes that have a component: every pair of a component's nodes is compared, once.

    Two nodes alone are linked, or they would not be a component. Other small components share groups of about COUNT_TOKENS tokens; a
    larger one is dealt into blocks, and each pair of its blocks is a group of its own.
    """
    sizes = label.join(nodes.select("node", "n"), "node").groupBy("component").agg(F.count("*").alias("size"), F.sum("n").alias("tokens"))
    k = F.greatest(F.ceil(F.col("size") / COUNT_NODES), F.ceil(F.col("tokens") / COUNT_TOKENS)).cast("int")
    sizes = cut(sizes.select("component", "size", "tokens", k.alias("k")), "sizes")
    pairs = label.join(sizes.where("size = 2").select("component"), "component").select("node", F.lit(1).cast("long").alias("n_links"))
    more = label.join(sizes.where("size > 2"), "component")
    total = sizes.where("size > 2 and k = 1").agg(F.sum("tokens")).first()[0] or 0
    group = F.when(F.col("k") > 1, F.col("component")).otherwise(F.pmod(F.xxhash64("component"), F.lit(total // COUNT_TOKENS + 1)))
    more = more.select("node", "component", "k", group.alias("group"), F.pmod(F.xxhash64("node"), F.col("k")).cast("int").alias("block"))
    more = more.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    more = more.select("node", "component", "group", (F.col("k") > 1).alias("large"), "block", F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high"))
    more = more.join(sets_of(more.select("node").distinct(), docs, nodes), "node")
    counted = more.groupBy("large", "group", "low", "high").applyInPandas(lambda g: count_links(g, percent), "node long, n_links long")
    return pairs.unionByName(counted).groupBy("node").agg(F.sum("n_links").alias("n_links"))


def star_pairs(entries: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Of entries (sig, node, n, h): those that some partner in their entry may be alike enough to, and pairs (a, b) with the most central one.

    Sets that meet here share no rare token, or they have met before; so they share at most the lesser h. The set with fewest rare
    tokens is the most central.
    """
    def open_(rows: DataFrame) -> DataFrame:
        least = rows.groupBy("sig").agg(F.min("n").alias("least"), F.count("*").alias("size")).where("size > 1").drop("size")
        partner = F.greatest("least", F.ceil(F.col("n") * percent / 100))
        return rows.join(least, "sig").where(_enough(F.col("h"), F.col("n") + partner, percent)).select("sig", "node", "n", "h")

    rows = cut(open_(entries), "heavy")
    centre = rows.groupBy("sig").agg(F.min(F.struct(F.col("n") - F.col("h"), "node", "n", "h")).alias("c"))
    both = rows.join(centre, "sig").where(F.col("node") != F.col("c.node"))
    both = both.where(_enough(F.least("h", F.col("c.h")), F.col("n") + F.col("c.n"), percent))
    return rows, both.select(F.least("node", F.col("c.node")).alias("a"), F.greatest("node", F.col("c.node")).alias("b")).distinct()


def linked(docs: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (key, doc_id, n, node, bits), nodes (node, first, key, n, bits) and the component of each node with links.

    ``docs`` has doc_id, text and key. ``first`` is a node's least doc_id, ``key`` the row that its text is fetched from.
    """
    rows = cut(described(docs), "rows")
    nodes = rows.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("first"), F.min("key").alias("key"), F.first("n").alias("n"), F.first("bits").alias("bits"))
    nodes = cut(nodes, "nodes")

    frequent, threes = frequent_tokens(docs, nodes.agg(F.sum("n")).first()[0] or 0)
    entry = Window.partitionBy("sig", "goes_on")
    order = entry.orderBy("n", F.xxhash64("sig", "node"), "node")
    met = rare_entries(docs, frequent, percent)
    met = met.select("*", F.dense_rank().over(order).alias("k"), F.lag("node").over(order).alias("prev"), F.lag("n").over(order).alias("prev_n"))
    met = met.withColumn("m", F.max("k").over(entry)).where("(m > 1 or goes_on) and (prev is null or prev <> node)").drop("k")
    met = cut(met, "met")
    short = met.where("not goes_on")

    # sets whose prefix goes on into the frequent tokens
    sets = sets_of(met.where("goes_on").select("node").distinct(), docs, nodes)
    entries = cut(heavy_entries(sets, frequent, threes, percent), "entries")
    heavy, star = star_pairs(entries, percent)
    star = cut(star, "star")
    discard(sets, entries)

    # entries of rare tokens: neighbours, first in a part of the entries, then what is still apart
    pairs = short.where(100 * F.col("prev_n") >= percent * F.col("n"))
    near = [F.least("node", "prev").alias("a"), F.greatest("node", "prev").alias("b")]
    links = verified(pairs.where(F.pmod("sig", F.lit(PART)) == 0).select(*near).unionByName(star).distinct(), docs, nodes, percent)
    label = components(links)
    apart = pairs.select(*near).distinct()
    apart = apart.join(label.toDF("a", "la"), "a", "left").join(label.toDF("b", "lb"), "b", "left")
    apart = apart.where("coalesce(la, a) <> coalesce(lb, b)").select("a", "b")
    more = verified(apart, docs, nodes, percent)
    if not more.isEmpty():
        links = links.unionByName(more)
        label = components(links)
    tried = cut(pairs.select(*near).unionByName(star).distinct(), "tried")

    # what remains: pairs across components
    rest = short.where("m > 2").select("sig", "node", "n", F.col("n").alias("h")).unionByName(heavy).join(label, "node", "left")
    rest = rest.withColumn("component", F.coalesce("component", "node"))
    across = pairs_in_blocks(rest, nodes, percent).join(tried, ["a", "b"], "left_anti")
    more = verified(across, docs, nodes, percent)
    if not more.isEmpty():
        label = components(links.unionByName(more))
    discard(met, heavy, star, tried)
    return rows, nodes, label


def join_components(docs: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links for each row of ``docs``.

    Null and empty texts have no shingles and are components of their own. Rows that repeat a doc_id share the least component of
    their texts only if those link. n_links counts all other distinct sets that the document's set links to, each once however many
    documents have it; so exact copies are no links of each other. ``percent`` is the least similarity in hundredths.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", row_key().alias("key"))
    with scratch() as keep:
        rows, nodes, label = linked(docs, percent)
        degree = degrees(label, docs, nodes, percent)
        named = nodes.select("node", "first").join(label, "node", "left").join(degree, "node", "left")
        named = cut(named.select("node", F.coalesce("component", "node").alias("component"), F.coalesce("n_links", F.lit(0)).alias("n_links"), "first"), "named")
        keep(rows, named)
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = named.join(least, "component").select("node", "component_id", "n_links")
    out = rows.select("doc_id", "n", F.when(F.col("n") > 0, F.col("node")).alias("node")).join(named, "node", "left")
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")
    )


def one_of_each(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One row (all columns) of each component: that of least doc_id (null last), then node, key and the row's columns in order.

    Null and empty texts have no shingles; their rows all stay. Rows that repeat a doc_id go only with their own text's component. Columns may have
    any names and types; where one holds a map, rows alike in key are compared by its JSON text.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", row_key().alias("key"))
    with scratch() as keep:
        rows, _, label = linked(own, percent)
        found = rows.where("n > 0").groupBy("node", "key").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("times"))
        found = found.join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
        order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node", "key")
        least = found.groupBy("component").agg(F.min(order)["key"].alias("least"))
        found = found.join(least, "component").select(F.col("key").alias("join_key"), (F.col("key") == F.col("least")).alias("stays"), "times")
        # most rows stay as they are, alone with their key: only the keys of others are joined
        found = cut(found.where("not stays or times > 1"), "leaving")
        keep(found)
    packed = docs.select(row_key().alias("join_key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.struct(*comparable(docs)).alias("order"))
    alone = packed.join(found.select("join_key"), "join_key", "left_anti").select("row")
    again = packed.join(found.where("stays").select("join_key"), "join_key", "left_semi")
    return alone.unionByName(again.groupBy("join_key").agg(F.min_by("row", "order").alias("row")).select("row")).select("row.*")
