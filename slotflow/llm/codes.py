"""Vectors as short codes: each of their parts by the number of the nearest entry in a codebook of its own.

Everything is in whole numbers, so results do not depend on the order of rows. Vectors are stored in chunks. Within a chunk, each
part's pieces are put along a Hilbert curve and cut into flat blocks of neighbours; a block stores its bounding box and its sums.
In a round the distances between box and entries leave a short list of entries per block: those that may be nearest to some point
in the box. A block with one such entry gives its sums as they are; others are compared point by point with their lists.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from slotflow.llm.common import store

#: Numbers in a chunk of vectors, rows in a block, and numbers that a kernel holds at a time. They do not change results.
CHUNK_CELLS, BLOCK, KERNEL_CELLS = 2**21, 32, 2**20
#: Components below this stay in machine words: sums of squared differences of 2**13 of them fit into 64 bits.
SMALL = 2**24
CURVE_BITS = 60

CHUNK = (
    "ids array<string>, labels array<string>, kind string, vectors binary, places binary, low binary, high binary, sums binary, sums_kind string"
)


# Whole numbers of any size.


def whole(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), exactly: 64-bit numbers where all are small, else Python's."""
    with np.errstate(over="ignore"):
        scaled = np.floor(x * float(scale))
    if not scaled.size or np.abs(scaled).max() < SMALL:
        return scaled.astype(np.int64)
    exact = [math.floor(Fraction(float(v)) * scale) for v in x.ravel()]
    return np.array(exact, dtype=object).reshape(x.shape)


def packed(numbers: np.ndarray) -> tuple[str, bytes]:
    """Kind and bytes of whole numbers, in the narrowest form that holds them."""
    if numbers.dtype == object:
        return "text", ",".join(map(str, numbers.ravel())).encode()
    most = int(np.abs(numbers).max()) if numbers.size else 0
    kind = "<i2" if most < 2**15 else "<i4" if most < 2**31 else "<i8"
    return kind, numbers.astype(kind).tobytes()


def unpacked(kind: str, data: bytes) -> np.ndarray:
    if kind == "text":
        return np.array([int(v) for v in data.split(b",")] if data else [], dtype=object)
    return np.frombuffer(data, kind).astype(np.int64)


# Blocks along a Hilbert curve.


def curve_index(points: np.ndarray) -> np.ndarray:
    """The places of points on a Hilbert curve through their bounding box; of many dimensions the first ones count."""
    axes = points[:, :CURVE_BITS].astype(float)
    width = axes.shape[1]
    bits = max(1, min(10, CURVE_BITS // max(1, width)))
    low = axes.min(axis=0)
    x = ((axes - low) / np.maximum(axes.max(axis=0) - low, 1) * (2**bits - 1)).astype(np.int64)
    # from the highest bit down, a set bit reflects the first dimension's lower bits, others swap them
    for b in range(bits - 1, 0, -1):
        lower = (1 << b) - 1
        for i in range(width):
            up = (x[:, i] >> b) & 1 == 1
            swap = np.where(up, 0, (x[:, 0] ^ x[:, i]) & lower)
            x[:, 0] ^= np.where(up, lower, swap)
            if i:
                x[:, i] ^= swap
    for i in range(1, width):
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(len(x), np.int64)
    for b in range(bits - 1, 0, -1):
        flip ^= np.where((x[:, -1] >> b) & 1 == 1, (1 << b) - 1, 0)
    x ^= flip[:, None]
    index = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(width):
            index = index << 1 | (x[:, i] >> b) & 1
    return index


def in_blocks(part: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The part's pieces in curve order as blocks x rows x components; the last block is filled up with its last row."""
    rows = np.append(places, np.repeat(places[-1:], -len(places) % BLOCK))
    return part[rows].reshape(-1, BLOCK, part.shape[1])


def chunk_row(ids: list, labels: list, vectors: np.ndarray, parts: int) -> dict:
    """A chunk as stored: its vectors, and for each part the curve order and the blocks' boxes and sums."""
    places, low, high, sums = [], [], [], []
    for part in np.split(vectors, parts, axis=1):
        order = np.argsort(curve_index(part), kind="stable")
        blocks = in_blocks(part, order)
        total = blocks.sum(axis=1)
        total[-1] -= part[order[-1]] * (-len(part) % BLOCK)
        places.append(order)
        low.append(blocks.min(axis=1))
        high.append(blocks.max(axis=1))
        sums.append(total)
    kind, data = packed(vectors)
    sums_kind, sums_data = packed(np.stack(sums))
    # a box has the kind of the vectors: none of its numbers is larger
    box = lambda numbers: packed(np.stack(numbers))[1] if kind == "text" else np.stack(numbers).astype(kind).tobytes()
    return {
        "ids": ids, "labels": labels, "kind": kind, "vectors": data, "places": np.stack(places).astype("<u4").tobytes(),
        "low": box(low), "high": box(high), "sums": sums_data, "sums_kind": sums_kind,
    }


class Chunk:
    """A stored chunk, read back."""

    def __init__(self, row: dict, parts: int):
        self.ids, self.labels, self.parts, n = row["ids"], row["labels"], parts, len(row["ids"])
        self.vectors = unpacked(row["kind"], row["vectors"]).reshape(n, -1)
        self.places = np.frombuffer(row["places"], "<u4").reshape(parts, n)
        blocks = -(-n // BLOCK)
        self.low, self.high, self.sums = (
            unpacked(kind, row[name]).reshape(parts, blocks, -1) for name, kind in (("low", row["kind"]), ("high", row["kind"]), ("sums", row["sums_kind"]))
        )
        self.sizes = np.full(blocks, BLOCK)
        self.sizes[-1] = n - (blocks - 1) * BLOCK

    def meet(self, books: np.ndarray) -> np.ndarray:
        """The codebooks as numbers of the same form as the chunk's: machine words where both are small."""
        if self.vectors.dtype == object or np.abs(books).max() >= SMALL:
            self.vectors, self.low, self.high, self.sums = (a.astype(object) for a in (self.vectors, self.low, self.high, self.sums))
        return books.astype(self.vectors.dtype)

    def short_lists(self, part: int, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each block the entries that may be nearest to a point in its box, first and ascending, and their number."""
        near = far = 0
        for c in range(entries.shape[1]):
            low, high, own = self.low[part, :, c, None], self.high[part, :, c, None], entries[None, :, c]
            gap = np.maximum(np.maximum(low - own, own - high), 0)
            reach = np.maximum(np.abs(own - low), np.abs(own - high))
            near, far = near + gap * gap, far + reach * reach
        # an entry whose box distance is more than another's farthest point is nearest nowhere, nor does it tie
        listed = near <= far.min(axis=1)[:, None]
        # nor one that is farther than the best other in each corner: how much farther changes linearly within the box
        best = entries[far.argmin(axis=1)]
        least = (entries * entries).sum(axis=1) - (best * best).sum(axis=1)[:, None]
        for c in range(entries.shape[1]):
            slope = 2 * (best[:, None, c] - entries[None, :, c])
            least = least + np.minimum(slope * self.low[part, :, c, None], slope * self.high[part, :, c, None])
        listed &= least <= 0
        return np.argsort(~listed, axis=1, kind="stable"), listed.sum(axis=1)

    def nearest(self, part: int, entries: np.ndarray, lists: np.ndarray, sizes: np.ndarray, chosen: np.ndarray) -> Iterator:
        """For each set of blocks compared at once: their numbers, points, and each point's nearest entry and distance."""
        width = self.vectors.shape[1] // self.parts
        blocks = in_blocks(self.vectors[:, part * width : (part + 1) * width], self.places[part])
        # lists of about one length are compared together; entries that fill up a list are never nearest
        length = 1 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(int)
        for size in np.unique(length[chosen]):
            alike = chosen[length[chosen] == size]
            step = max(1, KERNEL_CELLS // (BLOCK * int(size)))
            for start in range(0, len(alike), step):
                some = alike[start : start + step]
                points, listed = blocks[some], lists[some, :size]
                far = 0
                for c in range(width):
                    gap = points[:, :, None, c] - entries[listed][:, None, :, c]
                    far = far + gap * gap
                at = far.argmin(axis=2)
                yield some, points, np.take_along_axis(listed, at, axis=1), np.take_along_axis(far, at[:, :, None], axis=2)[:, :, 0]

    def add_up(self, books: np.ndarray, totals: np.ndarray, counts: np.ndarray) -> None:
        """Add each part's sums and numbers by nearest entry."""
        for part, entries in enumerate(books):
            lists, sizes = self.short_lists(part, entries)
            sole = np.flatnonzero(sizes == 1)
            np.add.at(totals[part], lists[sole, 0], self.sums[part, sole])
            np.add.at(counts[part], lists[sole, 0], self.sizes[sole])
            for some, points, entry, _ in self.nearest(part, entries, lists, sizes, np.flatnonzero(sizes > 1)):
                real = np.arange(BLOCK) < self.sizes[some][:, None]
                np.add.at(totals[part], entry[real], points[real])
                counts[part] += np.bincount(entry[real], minlength=len(entries))

    def coded(self, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each vector's entries and summed squared distance."""
        codes = np.zeros((len(self.ids), self.parts), np.uint8)
        error = np.zeros(len(self.ids), self.vectors.dtype)
        for part, entries in enumerate(books):
            lists, sizes = self.short_lists(part, entries)
            for some, _, entry, far in self.nearest(part, entries, lists, sizes, np.arange(len(sizes))):
                real = np.arange(BLOCK) < self.sizes[some][:, None]
                rows = self.places[part][(some[:, None] * BLOCK + np.arange(BLOCK))[real]]
                codes[rows, part] = entry[real]
                error[rows] += far[real]
        return codes, error


@contextmanager
def rows_a_batch(spark: SparkSession, rows: int) -> Iterator[None]:
    """Few rows at a time go to Python: a stored chunk is one row."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def table_of(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


def chunked(rows: DataFrame, width: int, parts: int, scale: int) -> DataFrame:
    """``rows`` of ``id``, ``label`` and ``vector`` as stored chunks."""
    most = max(1, CHUNK_CELLS // width)
    text, binary = pa.string(), pa.binary()
    kinds = {"ids": pa.list_(text), "labels": pa.list_(text), "kind": text, "vectors": binary, "places": binary}
    schema = pa.schema(kinds | {"low": binary, "high": binary, "sums": binary, "sums_kind": text})

    def run(batches) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors = [], [], []

        def flush() -> Iterator[pa.RecordBatch]:
            if ids:
                yield table_of([chunk_row(list(ids), list(labels), whole(np.concatenate(vectors), scale), parts)], schema)
                for held in (ids, labels, vectors):
                    held.clear()

        for batch in batches:
            if not batch.num_rows:
                continue
            found = batch.column("vector")
            if pc.min_max(pc.list_value_length(found)).as_py() != {"min": width, "max": width}:
                raise ValueError(f"vectors differ in length: some have not {width} components")
            ids += batch.column("id").to_pylist()
            labels += batch.column("label").to_pylist()
            vectors.append(found.flatten().to_numpy(zero_copy_only=False).reshape(-1, width))
            if len(ids) >= most:
                yield from flush()
        yield from flush()

    return store(rows.mapInArrow(run, CHUNK))


def over_chunks(use: Callable[[Iterator[Chunk]], Iterator[pa.RecordBatch]], parts: int) -> Callable:
    def run(batches) -> Iterator[pa.RecordBatch]:
        yield from use(Chunk(row, parts) for batch in batches for row in batch.to_pylist())

    return run


def refined(chunks: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after a round: each used entry is the floored mean of its parts.

    Every task adds up its own chunks and sends a row per component of an entry, as many as the codebooks have numbers.
    """
    parts = len(books)
    schema = pa.schema({"part": pa.int32(), "entry": pa.int32(), "place": pa.int32(), "total": pa.decimal128(38), "n": pa.int64()})

    def use(found: Iterator[Chunk]) -> Iterator[pa.RecordBatch]:
        totals, counts = np.zeros(books.shape, object), np.zeros(books.shape[:2], np.int64)
        for chunk in found:
            met = chunk.meet(books)
            own = np.zeros_like(met)
            chunk.add_up(met, own, counts)
            totals += own
        part, entry, place = (a.ravel() for a in np.indices(books.shape, np.int32))
        used = np.repeat(counts.ravel(), books.shape[2])
        some = np.flatnonzero(used)
        total = pa.array([int(t) for t in totals.ravel()[some]], pa.decimal128(38))
        yield pa.RecordBatch.from_arrays([pa.array(part[some]), pa.array(entry[some]), pa.array(place[some]), total, pa.array(used[some])], schema=schema)

    sums = chunks.mapInArrow(over_chunks(use, parts), "part int, entry int, place int, total decimal(38,0), n bigint")
    after = books.copy()
    for row in sums.groupBy("part", "entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
        after[row.part, row.entry, row.place] = int(row.total) // row.n
    return after


def compressed(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 16, entries: int = 64,
    rounds: int = 2, scale: int = 256,
) -> tuple[DataFrame, np.ndarray]:
    """``key``, ``label``, ``code`` (two hex digits a part) and ``error`` of every vector, and the codebooks: parts x entries x components.

    Rows whose vector is null or holds null or non-finite components are dropped. Components become floor(scale * x) and vectors
    ``parts`` equal consecutive parts; vectors of other lengths than the first stop the job, as do lengths that ``parts`` does not
    divide. Codebooks start as the parts of the vectors with the ``entries`` smallest keys, nulls last, rows with one key by vector.
    In each round entries become the floored means of the parts that they are nearest to, the lower entry on a tie; unused ones
    stay. ``error`` is the sum of squared distances; one that does not fit into 64 bits stops the job. Repeated rows count each;
    null labels are kept; an empty table gives no rows; columns with other names are not looked at.

    One scan stores the chunks, then each round reads them; rows are never shuffled. The driver gets the codebooks and their sums.
    """
    if entries > 256:
        raise ValueError("a code has two hex digits a part")
    spark = vectors.sparkSession
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    rows = vectors.where(F.col(vector).isNotNull() & finite).select(
        F.col(key).alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector")
    )
    first = rows.select("id", "vector").orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).collect()
    result = "key string, label string, code string, error bigint"
    kinds = [F.col(name).cast(vectors.schema[was].dataType).alias(to) for name, was, to in (("key", key, key), ("label", label, "label"))]
    if not first:
        return spark.createDataFrame([], result).select(*kinds, "code", "error"), np.zeros((parts, 0, 0), object)
    width = len(first[0].vector)
    if not width or width % parts or any(len(row.vector) != width for row in first):
        raise ValueError(f"vectors must have one length that {parts} divides")
    start = whole(np.array([row.vector for row in first]), scale).astype(object)
    books = start.reshape(len(first), parts, width // parts).transpose(1, 0, 2)
    text = rows.select(F.col("id").cast("string").alias("id"), F.col("label").cast("string").alias("label"), "vector")
    with rows_a_batch(spark, 2000):
        chunks = chunked(text, width, parts, scale)
    with rows_a_batch(spark, 1):
        for _ in range(rounds):
            books = refined(chunks, books)

        def use(found: Iterator[Chunk]) -> Iterator[pa.RecordBatch]:
            for chunk in found:
                codes, error = chunk.coded(chunk.meet(books))
                digits, size = codes.tobytes().hex(), 2 * parts
                code = [digits[i : i + size] for i in range(0, len(digits), size)]
                columns = [pa.array(chunk.ids, pa.string()), pa.array(chunk.labels, pa.string()), pa.array(code), pa.array(error.tolist(), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "label", "code", "error"])

        coded = store(chunks.mapInArrow(over_chunks(use, parts), result))
    return coded.select(*kinds, "code", "error"), books


def book_digest(books: np.ndarray) -> str:
    """SHA-256 of all numbers of the codebooks by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(str(int(v)) for v in books.ravel()).encode()).hexdigest()


def restored(code: str, books: np.ndarray) -> np.ndarray:
    """The vector, in whole numbers, that a code stands for."""
    return np.concatenate([books[part, entry] for part, entry in enumerate(bytes.fromhex(code))])


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``, the sum of ``error`` over rows of one label; null labels are one group.

    Errors are added up before they are shuffled, and the sums, one row a label, are joined back.
    """
    sums = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")
