"""BPE encoding and decoding of whole texts; long text is encoded in halves and joined as a tree.

White space always ends a pre-token, so a short text is encoded run by run. A long one is halved until no part is long,
wherever the cuts fall; different tasks encode the parts. Where a cut falls within a pre-token, a window around the seam is
encoded again and grows until its outer tokens are those already found on both sides.

Why that is exact: a sequence of tokens is the BPE encoding of its text if and only if each adjacent pair is the
encoding of its own text, as the first merge that crosses a border between two tokens crosses it in the pair, too. In the
joined sequence every adjacent pair lies in the left encoding, the right one, or the window's.
"""

from __future__ import annotations

import gc
import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame, functions as F

from slotflow.llm.common import text_digest

#: Letters that stay letters when composed and lower-cased, then ASCII marks: one pre-token, or two.
LETTERS, MARKS = "A-Za-zÀ-ÖØ-öø-ÿ", "!-/:-@\\[-`{-~"
PLAIN = re.compile(f"([{LETTERS}]+)([{MARKS}]*)")
WHITE = re.compile("[ \\t\\n\\r]")
RESULT = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def split(text: str) -> list[str]:
    """The runs between spaces, tabs and line ends: white space to every tokenizer here. Other white space stays inside runs."""
    return list(filter(None, text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")))


class Codec:
    """A tokenizer read from its JSON file, by run of text. It remembers ``known`` runs, and those of a batch."""

    def __init__(self, path: str, known: int = 1 << 17):
        # a task has one core: threads of the library's own would only cost memory
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.path, self.most_known = path, known
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path) as file:
            spec = json.load(file)
        self.suffix = spec["model"].get("end_of_word_suffix") or ""
        self.added = [(t["content"], t["id"]) for t in spec["added_tokens"]]
        if spec.get("decoder") is not None or spec["post_processor"] is not None or any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: only tokenizers that split at white space and decode by joining tokens")
        self.names = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        self.numbers = [str(i) for i in range(len(self.names))]
        self.id_type = np.dtype("<u2" if len(self.names) <= 1 << 16 else "<u4")
        self.runs: dict[str, tuple[int, str, str]] = {}
        self.words: dict[str, tuple[int, str, str]] = {}
        self.open_model = None
        every = "".join(map(chr, range(256)))
        letters, marks = ("".join(re.findall(f"[{kind}]", every)) for kind in (LETTERS, MARKS))
        # one by one, as the library's normaliser and pre-tokeniser write them
        self.letter = str.maketrans({c: "".join(self.pre_tokens(c)) for c in letters + marks})
        self.is_plain = self.pre_tokens(letters + marks) == [letters.translate(self.letter), marks.translate(self.letter)]

    def pre_tokens(self, text: str) -> list[str]:
        normal = self.tokenizer.normalizer.normalize_str(text) if self.tokenizer.normalizer else text
        return [word for word, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]

    def learn(self, runs: set[str]) -> None:
        """Encode runs not seen before; their ids and tokens are kept as joined text.

        Most runs are letters with marks behind: two pre-tokens, which the library's model encodes once each, however many
        runs they stand in. Other runs go to the library whole. ``is_plain`` says whether the tokenizer splits in this way.
        """
        if len(self.runs) > self.most_known:
            self.runs.clear()
            self.words.clear()
        new = [r for r in runs if r not in self.runs]
        if self.is_plain:
            found = [PLAIN.fullmatch(r) for r in new]
            for run, match in zip(new, found):
                if match:
                    letters, marks = match.groups()
                    self.runs[run] = joined(self.word(letters), self.word(marks)) if marks else self.word(letters)
            new = [r for r, m in zip(new, found) if not m]
        for run, got in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False)):
            self.keep(run, got.ids)

    def word(self, text: str) -> tuple[int, str, str]:
        """The encoding of letters only, or of marks only."""
        text = text.translate(self.letter)
        found = self.words.get(text)
        if found is None:
            ids = [t.id for t in self.model.tokenize(text)]
            found = self.words[text] = (len(ids), " ".join([self.numbers[i] for i in ids]), self.decode(ids))
        return found

    def ids(self, runs: list[str]) -> np.ndarray:
        """The ids of runs that are known."""
        found = [self.runs[r] for r in runs]
        text = " ".join([x[1] for x in found if x[0]])
        return (np.fromstring(text, dtype=np.int64, sep=" ") if text else np.array([])).astype(self.id_type)

    def keep(self, run: str, ids: list[int]) -> None:
        self.runs[run] = (len(ids), " ".join([self.numbers[i] for i in ids]), self.decode(ids))

    def decode(self, ids: list[int]) -> str:
        """The tokens joined by a blank, as the library decodes where the file names no decoder."""
        return " ".join([self.names[i] for i in ids])

    def digest(self, found: list[tuple[int, str, str]]) -> tuple[int, str, str]:
        """Tokens, digest of the ids and digest of the decoded text of consecutive encodings."""
        found = [x for x in found if x[0]]
        ids, decoded = hashlib.sha256(" ".join([x[1] for x in found]).encode()), hashlib.sha256(" ".join([x[2] for x in found]).encode())
        return sum([x[0] for x in found]), ids.hexdigest(), decoded.hexdigest()

    # Long texts

    def cut(self, text: str, size: int) -> Iterator[tuple[int, str]]:
        """A text halved until no part has more than ``size`` characters, as (kind, text) like ``parts``.

        A cut between runs leaves whole runs on both sides. One within a run makes that run parts of its own: its
        normaliser and pre-tokeniser must see it whole, the pre-tokens that come out are then halved.
        """
        n = 1
        while len(text) > size * n:
            n *= 2
        start = 0
        for seam in (len(text) * i // n for i in range(1, n)):
            if seam < start:  # within a run that is cut already
                continue
            begin = max(start, 1 + max(text.rfind(white, start, seam) for white in " \t\n\r"))
            after = WHITE.search(text, seam)
            end = after.start() if after else len(text)
            if begin == seam or end == seam:
                begin = end = seam
            if begin > start:
                yield 0, text[start:begin]
            if end > begin:
                yield from self.parts(text[begin:end], size if end - begin > size else (end - begin + 1) // 2)
            start = end
        if start < len(text):
            yield 0, text[start:]

    def parts(self, run: str, size: int) -> list[tuple[int, str]]:
        """A run as (kind, text): 1 a part of a pre-token that goes on, 2 its last part, 3 a special token; 0 is for whole runs.

        Strings of special tokens are found first, as the library does; then come its normaliser and pre-tokeniser,
        both linear. Pre-tokens of more than ``size`` letters are halved until no part is longer.
        """
        special = "|".join(re.escape(t) for t, _ in self.added)
        pieces = re.split(f"({special})", run) if special else [run]
        out: list[tuple[int, str]] = []
        whole = {t for t, _ in self.added}
        for piece in pieces:
            if piece in whole:
                out.append((3, piece))
            elif piece:
                for word in self.pre_tokens(piece):
                    cut = halves(word, size)
                    out += [(1, part) for part in cut[:-1]] + [(2, cut[-1])]
        return out

    def encode_part(self, kind: int, text: str) -> list[int]:
        """Ids of a part: the end of a pre-token carries the mark for word ends, a part that goes on doesn't."""
        if kind == 3:
            return [dict(self.added)[text]]
        if kind == 2:
            return [t.id for t in self.model.tokenize(text)]
        if self.open_model is None:
            from tokenizers.models import BPE

            with open(self.path) as file:
                spec = json.load(file)["model"]
            merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["merges"]]
            self.open_model = BPE(vocab=spec["vocab"], merges=merges)
        return [t.id for t in self.open_model.tokenize(text)]

    def join(self, left: list[int], right: list[int], last: bool) -> list[int]:
        """The encoding of two neighbours' text; ``last`` if the right one ends the pre-token."""
        if not left or not right:
            return left + right
        wide = 2
        while True:
            a, b = max(0, len(left) - wide), min(len(right), wide)
            ends = last and b == len(right)
            inner = left[a:] + right[:b]
            text = "".join(self.tokenizer.id_to_token(i) for i in inner)
            if ends and self.suffix:
                text = text[: -len(self.suffix)]
            window = self.encode_part(2 if ends else 1, text)
            if (a == 0 or window[0] == left[a]) and (b == len(right) or window[-1] == right[b - 1]):
                return left[:a] + window + right[b:]
            wide *= 2

    def concatenate(self, parts: list[list[int]]) -> list[int]:
        """Encodings of the parts of one pre-token, joined pairwise until one is left."""
        first = True
        while first or len(parts) > 1:
            first = False
            ends = len(parts)
            parts = [self.join(parts[i], parts[i + 1], i + 2 == ends) if i + 1 < ends else parts[i] for i in range(0, ends, 2)]
        return parts[0]


def halves(text: str, size: int) -> list[str]:
    if len(text) <= size:
        return [text]
    middle = len(text) // 2
    return halves(text[:middle], size) + halves(text[middle:], size)


def joined(left: tuple[int, str, str], right: tuple[int, str, str]) -> tuple[int, str, str]:
    if not left[0] or not right[0]:
        return left if left[0] else right
    return left[0] + right[0], f"{left[1]} {right[1]}", f"{left[2]} {right[2]}"


class Digests:
    """Number and digests of the tokens of one text, whose parts come in order; parts of a pre-token are joined first."""

    def __init__(self, codec: Codec):
        self.codec, self.n, self.going = codec, 0, []
        self.ids, self.decoded = hashlib.sha256(), hashlib.sha256()

    def add(self, kind: int, ids: np.ndarray, at_once: int = 1 << 16) -> None:
        found = ids.tolist()
        if kind in (1, 2):
            self.going.append(found)
            if kind == 1:
                return
            found, self.going = self.codec.concatenate(self.going), []
        for start in range(0, len(found), at_once):
            some = found[start : start + at_once]
            blank = " " if self.n else ""
            self.ids.update((blank + " ".join([self.codec.numbers[i] for i in some])).encode())
            self.decoded.update((blank + self.codec.decode(some)).encode())
            self.n += len(some)

    def result(self) -> tuple[int, str, str]:
        return self.n, self.ids.hexdigest(), self.decoded.hexdigest()


def bpe_digests(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", run: int = 10_000) -> DataFrame:
    """Ids and decoded text of every whole text, as digests: ``key``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``.

    The ids are those of the library without added special tokens, strings of special tokens inside texts included as it
    reads them. Null and empty texts have no ids and decode to the empty text. One row per row of ``docs``, repeated rows
    and null keys included; an empty table gives no rows; other columns are not looked at. ``tokenizer_path`` must be
    readable by the executors.

    Texts of more than ``run`` characters go by parts: see ``encode_long``.
    """
    rows = docs.select(F.col(key).cast("string").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    is_long = F.char_length("text") > run

    def encode(batches) -> Iterator:
        import pandas as pd

        # the many small tuples kept here hold no cycles: look for cycles less often
        gc.set_threshold(200_000, 20, 100)
        codec = Codec(tokenizer_path)
        for batch in batches:
            cut = [split(t) for t in batch["text"]]
            codec.learn(set().union(*cut))
            found = [codec.digest([codec.runs[r] for r in runs]) for runs in cut]
            yield pd.DataFrame(found, columns=["n_tokens", "ids_sha256", "decoded_sha256"]).assign(key=batch["key"].values)

    short = rows.where(~is_long).mapInPandas(encode, f"{RESULT}, key string")
    found = short.unionByName(encode_long(rows.where(is_long), tokenizer_path, run))
    return found.select(F.col("key").cast(docs.schema[key].dataType).alias(key), "n_tokens", "ids_sha256", "decoded_sha256")


def encode_long(rows: DataFrame, tokenizer_path: str, size: int) -> DataFrame:
    """Digests of long texts: halved into parts of at most ``size`` characters, encoded by different tasks, then joined in order.

    Texts are named by their SHA-256, so equal ones are encoded once and a task that runs again gives the same names.
    A text's digests need its tokens in order: one task reads them as a sorted stream and holds a part at a time, or the
    parts of one pre-token.
    """
    named = rows.select("key", "text", text_digest(F.col("text")).alias("own"))

    def cut(batches) -> Iterator:
        import pandas as pd

        codec = Codec(tokenizer_path)
        for batch in batches:
            for own, text in zip(batch["own"], batch["text"]):
                numbered = enumerate(codec.cut(text, size))
                while some := list(islice(numbered, 256)):
                    yield pd.DataFrame({"own": own, "part": [i for i, _ in some], "kind": [k for _, (k, _) in some], "text": [t for _, (_, t) in some]})

    def encode(batches) -> Iterator:
        gc.set_threshold(200_000, 20, 100)
        codec = Codec(tokenizer_path)
        for batch in batches:
            runs = [split(t) if k == 0 else [] for k, t in zip(batch["kind"], batch["text"])]
            codec.learn(set().union(*runs))
            ids = [codec.ids(r) if k == 0 else np.array(codec.encode_part(k, t), codec.id_type) for k, t, r in zip(batch["kind"], batch["text"], runs)]
            yield batch[["own", "part", "kind"]].assign(ids=[i.tobytes() for i in ids])

    def join(batches) -> Iterator:
        import pandas as pd

        codec = Codec(tokenizer_path)
        own, digests = None, None
        columns = ["own", "n_tokens", "ids_sha256", "decoded_sha256"]
        for batch in batches:
            done = []
            for name, kind, ids in zip(batch["own"], batch["kind"], batch["ids"]):
                if name != own:
                    if digests:
                        done.append((own, *digests.result()))
                    own, digests = name, Digests(codec)
                digests.add(kind, np.frombuffer(ids, codec.id_type))
            yield pd.DataFrame(done, columns=columns)
        if digests:
            yield pd.DataFrame([(own, *digests.result())], columns=columns)

    parts = named.select("own", "text").mapInPandas(cut, "own binary, part int, kind int, text string").dropDuplicates(["own", "part"])
    encoded = parts.mapInPandas(encode, "own binary, part int, kind int, ids binary")
    found = encoded.repartition("own").sortWithinPartitions("own", "part").mapInPandas(join, f"own binary, {RESULT}")
    return named.select("key", "own").join(found, "own").drop("own")
