"""Vector code compression: product codes whose codebooks are fitted with anchors-hierarchy metric trees over the parts of the vectors.

Vectors are cut into parts, and every part position has a codebook. Blocks of vectors are dealt to tasks; each block has one tree for every
part position, built middle-out: about as many anchors as the square root of its points, each new one the point furthest from all
others, taking only points that the triangle inequality leaves open; anchors are merged upwards by the smallest ball that holds two of
them, and large anchors are split again downwards. Every ball caches the sum and the number of its points. A codebook walks down a tree with
a list of candidate entries that children inherit: an entry goes once another one is nearer to every point of the ball, and when one entry is
left, it owns the ball, whose cached sum and number count at once. Arithmetic on results is in integers, and balls only ever leave out
entries that are further from every point, so assignments are those of an exhaustive search.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import SALTS, cut
from tallyline.llm.words import in_turn

#: Parts of a vector, entries of a codebook, rounds of refinement, and what components are multiplied by.
PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Vectors of a block, and points that a ball may have without being split.
BLOCK, LEAF = 4096, 96
#: Integer components are held within this bound, so that errors fit a long.
MOST = 1 << 28
BLOCKS = "vec_ids array<long>, labels array<{label}>, trees array<binary>"


def _far(x: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Distances of some points to one."""
    return np.sqrt(((x - one) ** 2).sum(axis=1))


def anchors(x: np.ndarray, most: int) -> np.ndarray:
    """The anchor of each point, by number. The first point is the first anchor; the point furthest from its anchor becomes the next.

    A new anchor takes points that are nearer to it; those nearer to their anchor than half the distance between both are not looked at.
    """
    owner, far, pivots = np.zeros(len(x), np.int64), _far(x, x[0]), [0]
    while len(pivots) < most:
        new = int(far.argmax())
        if far[new] == 0:
            break
        apart = _far(x[pivots], x[new])
        open_ = np.flatnonzero(far > apart[owner] / 2)
        own = _far(x[open_], x[new])
        nearer = own < far[open_]
        owner[open_[nearer]], far[open_[nearer]] = len(pivots), own[nearer]
        pivots.append(new)
    return owner


class Tree:
    """Balls over the points of one part: arrays with a row a ball (0 is the root), and points in an order in which every ball is a range."""

    FIELDS = ["order", "points", "centre", "radius", "sums", "start", "end", "left", "right"]

    def __init__(self, **fields: np.ndarray):
        self.__dict__.update(fields)

    @classmethod
    def build(cls, points: np.ndarray) -> Tree:
        x = points.astype(np.float64)
        held: list[np.ndarray] = []  # the points of each ball
        children: list[tuple[int, int]] = []
        centres: list[np.ndarray] = []
        radii: list[float] = []

        def ball(at: np.ndarray, left: int = -1, right: int = -1) -> int:
            centre = x[at].mean(axis=0)
            held.append(at)
            children.append((left, right))
            centres.append(centre)
            radii.append(float(_far(x[at], centre).max()))
            return len(held) - 1

        def merged(balls: list[int]) -> int:
            """One ball over some: the two whose joint ball is smallest are merged, again and again."""
            c, r = np.array([centres[b] for b in balls]), np.array([radii[b] for b in balls])
            n = np.array([len(held[b]) for b in balls], np.float64)

            def joint(i: int) -> np.ndarray:
                middle = (c * n[:, None] + c[i] * n[i]) / (n + n[i])[:, None]
                return np.maximum(np.sqrt(((middle - c) ** 2).sum(axis=1)) + r, np.sqrt(((middle - c[i]) ** 2).sum(axis=1)) + r[i])

            names, live = list(balls), np.ones(len(balls), bool)
            size = np.stack([joint(i) for i in range(len(balls))])
            np.fill_diagonal(size, np.inf)
            for _ in range(len(balls) - 1):
                i, j = divmod(int(size.argmin()), len(balls))
                names[i] = ball(np.concatenate([held[names[i]], held[names[j]]]), names[i], names[j])
                c[i], r[i], n[i], live[j] = centres[names[i]], radii[names[i]], n[i] + n[j], False
                size[j, :] = size[:, j] = np.inf
                size[i, :] = size[:, i] = np.where(live, joint(i), np.inf)
                size[i, i] = np.inf
            return names[int(np.flatnonzero(live)[0])]

        def grow(at: np.ndarray) -> int:
            if len(at) > LEAF:
                owner = anchors(x[at], int(np.ceil(np.sqrt(len(at)))))
                if owner.any():
                    return merged([grow(at[owner == k]) for k in range(int(owner.max()) + 1)])
            return ball(at)

        root = grow(np.arange(len(x)))
        # the last ball is the root; balls are numbered anew from there, and each is a range of the points in order
        number, start, end, order, stack, at = {}, [], [], [], [root], 0
        while stack:
            b = stack.pop()
            number[b] = len(number)
            start.append(at)
            end.append(at + len(held[b]))
            left, right = children[b]
            if left < 0:
                order.append(held[b])
                at += len(held[b])
            else:
                stack += [right, left]
        rows = sorted(number, key=number.__getitem__)
        order = np.concatenate(order).astype(np.int32)
        kind = np.int16 if np.abs(points).max(initial=0) < 1 << 15 else np.int32
        child = np.array([[number.get(c, -1) for c in children[b]] for b in rows], np.int32)
        total = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(points[order], axis=0)])
        start, end = np.array(start, np.int32), np.array(end, np.int32)
        return cls(order=order, points=points[order].astype(kind), centre=np.array([centres[b] for b in rows]), radius=np.array([radii[b] for b in rows]),
                   sums=total[end] - total[start], start=start, end=end, left=child[:, 0], right=child[:, 1])

    def dump(self) -> bytes:
        out = io.BytesIO()
        for name in self.FIELDS:
            np.save(out, getattr(self, name), allow_pickle=False)
        return out.getvalue()

    @classmethod
    def load(cls, blob: bytes) -> Tree:
        held = io.BytesIO(blob)
        return cls(**{name: np.load(held, allow_pickle=False) for name in cls.FIELDS})

    def walk(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, np.ndarray]]]:
        """Balls that one entry owns, their owners, and (start, end, entry of each point) for the others that have no children.

        For a point x of a ball around c with radius r, |x-e|^2 - |x-b|^2 is linear in x, so at least |c-e|^2 - |c-b|^2 - 2 r |e-b|: where that
        is above 0 (by more than rounding may matter), e is further than b from the whole ball. Of entries alike only the first is a candidate.
        """
        e = entries.astype(np.float64)
        squares = (e**2).sum(axis=1)
        between = np.sqrt(np.maximum(((e[:, None, :] - e[None, :, :]) ** 2).sum(axis=2), 0))
        first = np.zeros(len(e), bool)
        first[np.unique(entries, axis=0, return_index=True)[1]] = True
        balls, open_ = np.zeros(1, np.int64), first[None, :]
        owned, owner, rest = [np.empty(0, np.int64)], [np.empty(0, np.int64)], []
        while len(balls):
            c, own = self.centre[balls], np.arange(len(balls))
            size = (c**2).sum(axis=1)[:, None]
            d = np.where(open_, size - 2 * (c @ e.T) + squares, np.inf)
            best = d.argmin(axis=1)
            slack = 1e-9 * (1 + size + squares.max())
            open_ = open_ & (d - d[own, best][:, None] - 2 * self.radius[balls][:, None] * between[best] <= slack)
            one = open_.sum(axis=1) == 1
            owned.append(balls[one])
            owner.append(best[one])
            balls, open_ = balls[~one], open_[~one]
            inner = self.left[balls] >= 0
            for b, candidates in zip(balls[~inner].tolist(), open_[~inner], strict=True):
                at, (s, t) = np.flatnonzero(candidates), (int(self.start[b]), int(self.end[b]))
                rest.append((s, t, at[distances(self.points[s:t], entries[at]).argmin(axis=1)]))
            balls, open_ = np.concatenate([self.left[balls[inner]], self.right[balls[inner]]]), np.concatenate([open_[inner], open_[inner]])
        return np.concatenate(owned), np.concatenate(owner), rest

    def totals(self, entries: np.ndarray) -> np.ndarray:
        """For each entry the number of its points and their sum by component."""
        out = np.zeros((len(entries), 1 + entries.shape[1]), np.int64)
        owned, owner, rest = self.walk(entries)
        np.add.at(out, owner, np.concatenate([(self.end - self.start)[owned, None].astype(np.int64), self.sums[owned]], axis=1))
        for s, t, nearest in rest:
            np.add.at(out[:, 0], nearest, 1)
            np.add.at(out[:, 1:], nearest, self.points[s:t].astype(np.int64))
        return out

    def assign(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each point, by the points' first order, and its squared distance."""
        found = np.empty(len(self.points), np.int64)
        owned, owner, rest = self.walk(entries)
        for b, k in zip(owned.tolist(), owner.tolist(), strict=True):
            found[self.start[b] : self.end[b]] = k
        for s, t, nearest in rest:
            found[s:t] = nearest
        error = ((self.points.astype(np.int64) - entries[found]) ** 2).sum(axis=1)
        entry, off = np.empty_like(found), np.empty_like(error)
        entry[self.order], off[self.order] = found, error
        return entry, off


def distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances, exact: as products of floats where all their parts are integers below 2^52, else by differences."""
    most = max(int(np.abs(points).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * points.shape[1] * most * most < 1 << 52:
        p, e = points.astype(np.float64), entries.astype(np.float64)
        return (p**2).sum(axis=1)[:, None] - 2 * (p @ e.T) + (e**2).sum(axis=1)
    return ((points.astype(np.int64)[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)


def kept(vectors: DataFrame) -> DataFrame:
    """vec_id, label, embedding of the rows whose vector is not null and holds no null or non-finite component."""
    x = F.col("embedding")
    fine = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vectors.where(fine).select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")


def integers(vectors: pa.Array | list, width: int) -> np.ndarray:
    """A matrix of floor(SCALE * x), shorter vectors filled with 0 on the right."""
    if isinstance(vectors, pa.ListArray):
        offsets, flat = vectors.offsets.to_numpy().astype(np.int64), vectors.values.to_numpy(zero_copy_only=False).astype(np.float64)
    else:
        offsets = np.concatenate([[0], np.cumsum([len(v) for v in vectors])]).astype(np.int64)
        flat = np.array([x for v in vectors for x in v], np.float64)
    size = np.diff(offsets)
    out = np.zeros((len(size), width), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    at = np.arange(offsets[0], offsets[-1])
    out[row, at - np.repeat(offsets[:-1], size)] = np.floor(np.clip(flat[at] * SCALE, -MOST, MOST)).astype(np.int64)
    return out


def forest(rows: DataFrame, width: int, parts: int) -> DataFrame:
    """Blocks of vectors: their ids and labels, and a tree for every part position. Rows stay in their partition."""
    label = rows.schema["label"].dataType

    @in_turn("codes")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def block(some: pa.Table) -> pa.RecordBatch:
            x = integers(some.column(2).combine_chunks(), width)
            trees = [Tree.build(p).dump() for p in np.split(x, parts, axis=1)]
            lists = [pa.ListArray.from_arrays([0, some.num_rows], some.column(k).combine_chunks()) for k in (0, 1)]
            return pa.RecordBatch.from_arrays([*lists, pa.array([trees], pa.list_(pa.binary()))], ["vec_ids", "labels", "trees"])

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= BLOCK:
                table = pa.Table.from_batches(held)
                whole = table.num_rows // BLOCK * BLOCK
                for k in range(0, whole, BLOCK):
                    yield block(table.slice(k, BLOCK))
                held = table.slice(whole).to_batches()
        if sum(b.num_rows for b in held):
            yield block(pa.Table.from_batches(held))

    return rows.mapInArrow(run, BLOCKS.format(label=label.simpleString()))


def refined(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks (part, entry, position) after one round: each used entry the floor of the mean of its points.

    Tasks pass on one sum for each part, entry and position; what reaches the driver is as large as the codebooks.
    """

    @in_turn("codes")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((*books.shape[:2], 1 + books.shape[2]), np.int64)
        for batch in batches:
            for trees in batch.column(0):
                for k, blob in enumerate(trees.values):
                    total[k] += Tree.load(blob.as_py()).totals(books[k])
        part, entry = np.nonzero(total[:, :, 0])
        wide = total.shape[2]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(part, wide), pa.int32()), pa.array(np.repeat(entry, wide), pa.int32()), pa.array(np.tile(np.arange(wide), len(part)), pa.int32()),
             pa.array(total[part, entry].ravel(), pa.int64())], ["part", "entry", "position", "total"]
        )

    sums = blocks.select("trees").mapInArrow(run, "part int, entry int, position int, total long")
    found = sums.groupBy("part", "entry", "position").agg(F.sum("total").alias("total")).collect()
    out, number = books.copy(), {(r.part, r.entry): r.total for r in found if r.position == 0}
    for r in found:
        if r.position:
            out[r.part, r.entry, r.position - 1] = r.total // number[r.part, r.entry]
    return out


def first_books(rows: DataFrame, width: int, parts: int, entries: int) -> np.ndarray:
    """Codebooks (part, entry, position) of the vectors with the smallest ids, null last, ties to the smaller vector."""
    seeds = rows.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).select("embedding").collect()
    x = integers([r.embedding for r in seeds], width)
    return x.reshape(len(x), parts, width // parts).transpose(1, 0, 2)


def fit(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """Blocks of trees over the kept vectors (a written table), and the codebooks after all rounds."""
    rows = kept(vectors)
    longest = rows.agg(F.max(F.size("embedding"))).first()[0] or 0
    width = max(1, -(-longest // parts)) * parts
    blocks = cut(forest(rows, width, parts), "forest")
    books = first_books(rows, width, parts, entries)
    for _ in range(rounds if books.shape[1] else 0):
        books = refined(blocks, books)
    return blocks, books


def encode(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code (two hex digits a part) and error (squared distance, over all parts) for every vector of the blocks."""

    @in_turn("codes")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, labels, trees in zip(*(batch.column(k) for k in range(3)), strict=True):
                found = [Tree.load(blob.as_py()).assign(books[k]) for k, blob in enumerate(trees.values)]
                code = np.stack([entry for entry, _ in found], axis=1).astype(np.uint8).tobytes().hex()
                wide = 2 * len(found)
                text = pa.array([code[i : i + wide] for i in range(0, len(code), wide)], pa.string())
                error = pa.array(np.sum([off for _, off in found], axis=0), pa.int64())
                yield pa.RecordBatch.from_arrays([ids.values, labels.values, text, error], ["vec_id", "label", "code", "error"])

    label = blocks.schema["labels"].dataType.elementType.simpleString()
    return blocks.select("vec_ids", "labels", "trees").mapInArrow(run, f"vec_id long, label {label}, code string, error long")


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components of the codebooks in decimal, by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 for every row with a vector of finite components; other rows go.

    A null vec_id or label is a value like others: its row stays, and null labels count together. Repeated rows stay; of several rows with one id
    the smaller vector comes first where codebooks begin. With fewer rows than ``entries`` codebooks have as many entries as rows; without
    rows there is no result. Shorter vectors count as filled with 0 up to the longest, and all up to a multiple of ``parts``; integer
    components beyond 2^28 count as that. Reads vec_id, label and embedding only.
    """
    blocks, books = fit(vectors, parts, entries, rounds)
    coded = cut(encode(blocks, books), "codes")
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    by_label = by_label.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))  # a label may have most rows
    salted = coded.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
    joined = salted.join(by_label, (F.col("salt") == F.col("copy")) & F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """The same in DuckDB SQL, by comparing every part with every entry; for vectors of one length that is a multiple of ``parts``."""
    steps = [f"b0 as (select part, r - 1 as entry, v from p where r <= {entries})"]
    nearest = """a{k} as (select r, part, arg_min(entry, (d, entry)) as entry, min(d) as d from (
  select p.r, p.part, b.entry, list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d from p join b{k} b using (part)) group by 1, 2)"""
    mean = """n{k} as (select part, entry, list(m order by i) as v from (select part, entry, i, (sum(x) - (sum(x) % count(*) + count(*)) % count(*)) // count(*) as m from (
  select a.part, a.entry, unnest(range(len(p.v))) as i, unnest(p.v) as x from a{k} a join p using (r, part)) group by 1, 2, 3) group by 1, 2),
b{n} as (select part, entry, coalesce(n.v, b.v) as v from b{k} b left join n{k} n using (part, entry))"""
    for k in range(rounds):
        steps += [nearest.format(k=k), mean.format(k=k, n=k + 1)]
    steps.append(nearest.format(k=rounds))
    return f"""
with k as (
  select row_number() over (order by vec_id nulls last, embedding) as r, vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as x from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), p as (select r, part, x[part * (len(x) // {parts}) + 1:(part + 1) * (len(x) // {parts})] as v from k, range({parts}) t(part)),
{", ".join(steps)},
c as (select r, string_agg(printf('%02x', entry), '' order by part) as code, sum(d)::bigint as error from a{rounds} group by 1),
h as (select sha256(string_agg(array_to_string(v, ','), ',' order by part, entry)) as h from b{rounds})
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, (select h from h) as codebooks_sha256 from k join c using (r)"""
