"""Token counts without token ids: pieces are counted once per distinct pre-token and joined to frequencies.

The pieces of a SentencePiece BPE model hold the space mark at their start only, so no merge crosses the place
before a run of spaces. Cut there, a text falls into pre-tokens whose counts add up to the count of the text.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, functions as F

from slotflow.llm.common import store

SPACE = "▁"
RUNS = re.compile(" *[^ ]+| +")


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens of a text, without the space mark that each begins with. Empty text has none."""
    if not text:
        return []
    if SPACE in text:
        text = text.replace(SPACE, " ")
    if "  " not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    return [run[1:] for run in RUNS.findall(" " + text)]


def model(path: str):
    import sentencepiece

    loaded = sentencepiece.SentencePieceProcessor(model_file=path)
    for i in range(loaded.get_piece_size()):
        if SPACE in loaded.id_to_piece(i).lstrip(SPACE):
            raise ValueError(f"{path}: piece {i} holds a space mark behind its start; texts cannot be cut at spaces")
    return loaded


def piece_counts(loaded, words: list[str]) -> list[int]:
    """The pieces of each pre-token. A lone space mark is the text's last space, which the library sees behind a word."""
    mark = 1 if not loaded.is_unknown(loaded.piece_to_id(SPACE)) else len(SPACE.encode())
    return [len(ids) if word else mark for word, ids in zip(words, loaded.encode(words, num_threads=1))]


def pack(numbers) -> bytes:
    """Whole numbers below 2**32, compressed byte by byte: most are small."""
    planes = np.ascontiguousarray(numbers, "<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(planes.tobytes(), 3)


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def pack_words(words: list[str]) -> bytes | None:
    """Sorted words, compressed, with the space mark between them: no pre-token holds one. None for no words."""
    return zstandard.compress(SPACE.join(words).encode(), 3) if words else None


def unpack_words(data: bytes) -> list[str]:
    return zstandard.decompress(data).decode().split(SPACE)


#: One word in so many, by hash, is looked at to tell how many distinct ones there are.
SAMPLE = 1 << 10
BLOCK = "block string, keys array<string>, sizes array<bigint>, ends array<int>, steps binary, times binary, words array<binary>, sample array<string>"


def blocks(docs: DataFrame, key: str, text: str, buckets: int, block_chars: int) -> DataFrame:
    """A row per block of documents: its distinct pre-tokens by hash bucket, and the frequencies per document.

    ``words[b]`` are the distinct pre-tokens of bucket b, sorted; through all buckets they are numbered on. Document i owns
    the numbers from ``ends[i-1]`` to ``ends[i]``, in rising order; ``steps`` are the differences from one to the next,
    and ``times`` how often each occurs. ``sample`` are the pre-tokens whose hash begins with ten zero bits.
    """

    def split(batches) -> Iterator:
        from pyspark import TaskContext

        task, number = TaskContext.get().partitionId(), 0
        keys, sizes, ends, word, times, seen, chars = [], [], [], [], [], {}, 0

        def block():
            hashes = [zlib.crc32(w.encode()) for w in seen]
            listed: list[list[str]] = [[] for _ in range(buckets)]
            for w, h in zip(seen, hashes):
                listed[h % buckets].append(w)
            rank = np.empty(len(seen), np.int64)
            start = 0
            for some in listed:
                some.sort()
                rank[[seen[w] for w in some]] = np.arange(start, start + len(some))
                start += len(some)
            numbers, owner = rank[np.array(word, np.int64)], np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
            order = np.lexsort((numbers, owner))
            row = {
                "block": f"{task}-{number}",
                "keys": list(keys),
                "sizes": np.array(sizes, np.int64),
                "ends": np.array(ends, np.int32),
                # a step back, where a document begins, wraps around
                "steps": pack(np.diff(numbers[order], prepend=0) % 2**32),
                "times": pack(np.array(times, np.int64)[order]),
                "words": [pack_words(some) for some in listed],
                "sample": [w for w, h in zip(seen, hashes) if h < 2**32 // SAMPLE],
            }
            return pd.DataFrame({name: [value] for name, value in row.items()})

        for batch in batches:
            for k, t in zip(batch["key"], batch["text"]):
                t = t or ""
                found = Counter(pre_tokens(t))
                word.extend([seen.setdefault(w, len(seen)) for w in found])
                times.extend(found.values())
                keys.append(k)
                sizes.append(len(t.encode()))
                ends.append(len(word))
                chars += len(t)
                if chars >= block_chars:
                    yield block()
                    number += 1
                    keys, sizes, ends, word, times, seen, chars = [], [], [], [], [], {}, 0
        if keys:
            yield block()

    # the key travels as text, so that nulls and 64-bit numbers pass pandas unchanged
    texts = docs.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"))
    return texts.mapInPandas(split, BLOCK)


def token_counts(
    docs: DataFrame,
    model_path: str,
    key: str = "doc_id",
    text: str = "text",
    buckets: int | None = None,
    block_chars: int = 8 << 20,
    most_words: int = 1 << 20,
) -> DataFrame:
    """The tokens of every text as the model gives them: ``key``, ``n_bytes``, ``n_tokens``, a row per row of ``docs``.

    Null and empty texts have no bytes and no tokens. Equal rows give equal results, one each; null keys are kept;
    other columns are not looked at. ``model_path`` must be readable by the executors. A pre-token travels once per
    block, as text; the task of its hash bucket counts its pieces once and sends the number back to the blocks, which
    add up number times frequency. A frequent pre-token is thus one short string a block: no key is hot.
    ``buckets`` are as many as shuffle partitions, 64 at least, each in as many parts as it takes for a part to hold about
    ``most_words`` distinct pre-tokens, by a hash sample of them all; a task knows those of one part at a time. A text of any length
    is read whole, by one task. An empty table gives no rows.
    """
    buckets = buckets or max(64, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    kept = store(blocks(docs, key, text, buckets, block_chars))
    strings = kept.select("block", F.posexplode("words").alias("bucket", "words")).where("words is not null")
    sample = kept.select(F.explode("sample").alias("word")).distinct()
    # a row per bucket
    sampled = sample.groupBy((F.crc32(F.encode("word", "UTF-8")) % buckets).alias("bucket")).agg(F.count(F.lit(1)).alias("n")).collect()
    parts = {r["bucket"]: 1 + r["n"] * SAMPLE // most_words for r in sampled}

    def cut(batches) -> Iterator:
        """Lists by part of their bucket; ``at`` are the places of a part's words in the list, null if it is the whole list."""
        for batch in batches:
            rows = []
            for block, bucket, packed in batch[["block", "bucket", "words"]].itertuples(index=False):
                some = parts.get(bucket, 1)
                if some == 1:
                    rows.append((block, bucket, 0, None, packed))
                    continue
                words = unpack_words(packed)
                part = np.array([zlib.crc32(w.encode()) // buckets % some for w in words])
                for p in np.unique(part).tolist():
                    at = np.flatnonzero(part == p)
                    rows.append((block, bucket, p, pack(np.diff(at, prepend=0)), pack_words([words[i] for i in at])))
            yield pd.DataFrame(rows, columns=["block", "bucket", "part", "at", "words"])

    def count(batches) -> Iterator:
        loaded = model(model_path)
        known: dict[str, int] = {}
        at = None
        for batch in batches:
            pieces = []
            for place, words in zip(zip(batch["bucket"], batch["part"]), map(unpack_words, batch["words"])):
                if place != at:
                    at, known = place, {}
                new = [w for w in words if w not in known]
                known.update(zip(new, piece_counts(loaded, new)))
                pieces.append(pack([known[w] for w in words]))
            yield batch[["block", "bucket", "at"]].assign(pieces=pieces)

    lists = strings.mapInPandas(cut, "block string, bucket int, part int, at binary, words binary")
    by_part = lists.repartition("bucket", "part").sortWithinPartitions("bucket", "part")
    counts = by_part.mapInPandas(count, "block string, bucket int, at binary, pieces binary")

    def whole(lists: pd.DataFrame) -> np.ndarray:
        """The pieces of a bucket's words, in their order."""
        pieces = [unpack(x).astype(np.int64) for x in lists["pieces"]]
        if len(pieces) == 1:
            return pieces[0]
        every = np.empty(sum(map(len, pieces)), np.int64)
        for at, some in zip(lists["at"], pieces):
            every[np.cumsum(unpack(at), dtype=np.int64)] = some
        return every

    def add(left, right):
        pieces = [whole(lists) for _, lists in right.groupby("bucket")]
        pieces = np.concatenate(pieces) if pieces else np.zeros(0, np.int64)
        parts = [pd.DataFrame({"key": [], "n_bytes": [], "n_tokens": []})]
        for row in left.itertuples():
            numbers = np.cumsum(unpack(row.steps), dtype=np.uint32)
            sums = np.concatenate([[0], np.cumsum(pieces[numbers] * unpack(row.times).astype(np.int64))])
            parts.append(pd.DataFrame({"key": row.keys, "n_bytes": row.sizes, "n_tokens": np.diff(sums[np.asarray(row.ends)], prepend=0)}))
        return pd.concat(parts[1:] or parts)

    blocks_only = kept.drop("words", "sample").groupBy("block")
    sums = blocks_only.cogroup(counts.groupBy("block")).applyInPandas(add, "key string, n_bytes bigint, n_tokens bigint")
    return sums.select(F.col("key").cast(docs.schema[key].dataType).alias(key), "n_bytes", "n_tokens")
