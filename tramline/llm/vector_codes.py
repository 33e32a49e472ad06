"""Vector code compression: product quantisation whose nearest entries come from Orchard's search.

Components become integers (``scale`` times the component, rounded down), a vector is cut
into equal consecutive parts, and every part position has a codebook of at most ``entries``
entries. A codebook keeps, for every entry, the list of all entries sorted by their
distance from it. The search for a part's nearest entry starts at the entry with the
nearest component sum and walks that entry's list: entries met are marked visited and not
measured again; one that is nearer than the best so far (or as near with a lower index)
becomes the best, and the walk goes on in its list from the start; the walk ends at a list
entry farther from the best than twice the part's distance to it, as no entry from there
on can be as near (triangle inequality). All distances are squared and in integers, so the
result is the exact nearest entry, ties to the lower index. Lists are walked ``STRIDE``
entries at a time for all parts of an Arrow batch together.

Spark deals out the rows: a round is one pass over the table in which a task adds up count
and component sums of each entry's parts (``parts`` times ``entries`` rows per task, summed
again before and after one small shuffle), and the driver holds only the codebooks. The
codes of the last pass are staged, so that sums by label and the result read the same ones.

Defined results: a vector that is null, empty or holds a null or non-finite component is
dropped. The first codebooks come from the smallest ids, null first, equal ids by their
vectors; with fewer vectors than ``entries`` the codebooks are as short. Equal vectors get equal
codes; repeated rows come back as often as they came. No vectors give no rows. Kept vectors
of different lengths, a length that the parts do not divide, or components so large that
squared distances would leave 64 bits raise. Only id, vector and label are read; other columns,
however named, do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import same, sized, stage

#: List entries that one step of the walk reads.
STRIDE = 8
#: Vectors that are searched together.
ROWS_PER_STEP = 2048


class Codebooks:
    """Entries of every part position, shape (parts, entries, width), and their neighbour lists."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.parts, self.size, self.width = entries.shape
        apart = np.stack([((e[:, None] - e[None]) ** 2).sum(2) for e in entries])
        #: place k of entry i's list, and the part distance from which on it is worth a look:
        #: distance(i, k) <= 2 * d, with both squared: apart <= 4 * d
        self.lists = np.argsort(apart, axis=2, kind="stable")
        self.from_on = -(-np.take_along_axis(apart, self.lists, 2) // 4)
        sums = entries.sum(2)
        self.by_sum = np.argsort(sums, axis=1, kind="stable")
        self.sums = np.take_along_axis(sums, self.by_sum, 1)

    def start(self, part: np.ndarray, points: np.ndarray) -> np.ndarray:
        """For each point the entry of the nearest component sum."""
        out = np.empty(len(points), np.int64)
        total = points.sum(1)
        for p in range(self.parts):
            own = part == p
            sums = self.sums[p]
            right = np.searchsorted(sums, total[own]).clip(0, self.size - 1)
            left = (right - 1).clip(0)
            nearer = np.where(total[own] - sums[left] <= sums[right] - total[own], left, right)
            out[own] = self.by_sum[p][nearer]
        return out

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry for every part of every vector, shape (rows, parts)."""
        points = vectors.reshape(-1, self.width)
        part = np.tile(np.arange(self.parts), len(vectors))
        best = self.start(part, points)
        far = ((points - self.entries[part, best]) ** 2).sum(1)
        visited = np.zeros((len(points), self.size), bool)
        visited[np.arange(len(points)), best] = True
        place = np.zeros(len(points), np.int64)
        walking = np.arange(len(points))
        while len(walking):
            at = place[walking, None] + np.arange(STRIDE)
            listed = at < self.size
            at = np.minimum(at, self.size - 1)
            of = part[walking, None], best[walking, None], at
            entry = self.lists[of]
            within = listed & (self.from_on[of] <= far[walking, None])
            row, col = np.nonzero(within & ~visited[walking[:, None], entry])
            who, met = walking[row], entry[row, col]
            visited[who, met] = True
            distance = np.full(at.shape, np.iinfo(np.int64).max)
            distance[row, col] = ((points[who] - self.entries[part[who], met]) ** 2).sum(1)
            low = distance.min(1)
            index = np.where(distance == low[:, None], entry, self.size).min(1)
            better = (low < far[walking]) | ((low == far[walking]) & (index < best[walking]))
            moved = walking[better]
            best[moved], far[moved] = index[better], low[better]
            place[walking] += STRIDE
            place[moved] = 0
            # the last place of the stride decides whether the list goes on
            walking = walking[better | within[:, -1]]
        return best.reshape(-1, self.parts), far.reshape(-1, self.parts)

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _components(column: pa.Array, scale: int, parts: int) -> np.ndarray:
    """Integer components of the vectors of one Arrow column, shape (rows, dimensions)."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    width, rest = divmod(len(flat), len(column))
    if rest or width % parts or len(set(np.diff(column.offsets.to_numpy()))) != 1:
        raise ValueError(f"vectors need one length that {parts} divides")
    out = np.floor(flat * scale)
    if len(out) and np.abs(out).max() > (2.0 ** 61 / width) ** 0.5:
        raise OverflowError(f"a component beyond {(2.0 ** 61 / width) ** 0.5 / scale:.6g}: squared distances would leave 64 bits")
    return out.astype(np.int64).reshape(-1, width)


def _steps(batches, at: int, scale: int, parts: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_PER_STEP):
            part = batch.slice(start, ROWS_PER_STEP)
            yield part, _components(part.column(at), scale, parts)


def kept(vectors: DataFrame, id: str, vector: str, label: str) -> DataFrame:
    """(id, label, vector) of the rows whose vector is whole."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.filter((F.size(vector) > 0) & finite).select(
        F.col(id).alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector"))


def first_codebooks(rows: DataFrame, scale: int, parts: int, entries: int) -> np.ndarray:
    """(parts, entries, width) of the smallest ids; empty where there are no vectors."""
    found = rows.orderBy(F.col("id").asc_nulls_first(), "vector").limit(entries).select("vector").toArrow().column(0).combine_chunks()
    if not len(found):
        return np.zeros((parts, 0, 0), np.int64)
    whole = _components(found, scale, parts)
    return whole.reshape(len(whole), parts, -1).transpose(1, 0, 2).copy()


def next_codebooks(rows: DataFrame, entries: np.ndarray, scale: int) -> np.ndarray:
    """One round: every entry becomes the mean, rounded down, of the parts it is nearest to."""
    parts, size, width = entries.shape

    def step(batches):
        books = Codebooks(entries)
        count = np.zeros(parts * size, np.int64)
        total = np.zeros((parts * size, width), np.int64)
        for _, vectors in _steps(batches, 0, scale, parts):
            code, _ = books.nearest(vectors)
            slot = (code + np.arange(parts) * size).ravel()
            count += np.bincount(slot, minlength=len(count))
            order = np.argsort(slot, kind="stable")
            used, first = np.unique(slot[order], return_index=True)
            total[used] += np.add.reduceat(vectors.reshape(-1, width)[order], first, axis=0)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (used, count[used], *total[used].T)], names=names)

    names = ["slot", "n", *(f"s{i}" for i in range(width))]
    summed = rows.select("vector").mapInArrow(step, T.StructType([T.StructField(n, T.LongType()) for n in names]))
    found = summed.groupBy("slot").agg(*(F.sum(n).alias(n) for n in names[1:])).collect()
    out = entries.copy().reshape(parts * size, width)
    for slot, n, *total in found:
        out[slot] = np.array(total, np.int64) // n
    return out.reshape(entries.shape)


def trained(rows: DataFrame, scale: int, parts: int, entries: int, rounds: int) -> Codebooks | None:
    """Codebooks after ``rounds`` passes over all rows of ``kept``; None where there are none."""
    books = first_codebooks(rows, scale, parts, entries)
    if not books.size:
        return None
    for _ in range(rounds):
        books = next_codebooks(rows, books, scale)
    return Codebooks(books)


def assigned(rows: DataFrame, books: Codebooks, scale: int) -> DataFrame:
    """id, label, code (two hex digits a part) and error (squared distance, summed over the parts)."""
    entries, parts = books.entries, books.parts

    def step(batches):
        own = Codebooks(entries)
        for part, vectors in _steps(batches, 2, scale, parts):
            code, error = own.nearest(vectors)
            text = [c.tobytes().hex() for c in code.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(text, pa.string()), pa.array(error.sum(1))],
                                             names=["id", "label", "code", "error"])

    schema = T.StructType([rows.schema["id"], rows.schema["label"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    return rows.select("id", "label", "vector").mapInArrow(step, schema)


def with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` with label_error, the errors of equal labels (nulls together) summed."""
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    sums = stage(sums, "label-errors")
    joined = coded.join(sized(sums, sums.count(), 32), same(F.col("label"), F.col("of")), "left")
    return joined.select("id", "code", "error", "label_error")


def compressed(vectors: DataFrame, *, id: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = 1024,
               parts: int = 4, entries: int = 256, rounds: int = 4) -> DataFrame:
    """id (under its own name), code, error, label_error and codebooks_sha256 of every whole vector."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits a part: 1 to 256 entries")
    rows = kept(vectors, id, vector, label)
    books = trained(rows, scale, parts, entries, rounds)
    if books is None:
        none: list[Column] = [F.lit(None).cast(t).alias(n) for n, t in (("code", "string"), ("error", "long"), ("label_error", "long"))]
        return rows.select(F.col("id").alias(id), *none, F.lit(None).cast("string").alias("codebooks_sha256"))
    coded = stage(assigned(rows, books, scale), "codes")
    return with_label_error(coded).select(
        F.col("id").alias(id), "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))
