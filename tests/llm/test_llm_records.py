from __future__ import annotations

import glob
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from helpers import ODD_ROWS, contained, empty_docs, odd_docs, plain_spans, sha
from slotflow.llm import decontaminate, pii, sharding, warc

# Shards


@pytest.mark.parametrize("dimensions, bits", [(1, 4), (2, 1), (2, 4), (3, 3), (4, 2)])
def test_the_curve_visits_every_cell_by_single_steps(text_spark, dimensions, bits):
    cells = [F.expr(f"cast((id div {2 ** (bits * i)}) % {2**bits} as int)") for i in range(dimensions)]
    points = text_spark.range(2 ** (dimensions * bits)).select(F.array(*cells).alias("p"))
    walked = points.select("p", sharding.hilbert_index(F.col("p"), dimensions, bits).alias("h")).orderBy("h").collect()
    assert [r["h"] for r in walked] == list(range(2 ** (dimensions * bits)))
    assert all(sum(abs(a - b) for a, b in zip(r["p"], s["p"])) == 1 for r, s in zip(walked, walked[1:]))


@pytest.mark.parametrize("shards", [1, 4, 16, 40])
def test_shards_differ_by_one_row(text_spark, shards):
    docs = odd_docs(text_spark)
    found = sharding.hilbert_shards(docs, ["lang", "source", "n_chars"], shards=shards).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == Counter(
        (k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in ODD_ROWS
    )
    slots: dict[int, list[int]] = {}
    for r in found:
        slots.setdefault(r["shard"], []).append(r["slot"])
    counts = [len(slots.get(s, [])) for s in range(shards)]
    assert set(slots) <= set(range(shards)) and max(counts) - min(counts) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    placed = sorted(found, key=lambda r: (r["shard"], r["slot"]))
    assert [r["curve"] for r in placed] == sorted(r["curve"] for r in found)


def test_no_rows_no_shards(text_spark):
    assert sharding.hilbert_shards(empty_docs(text_spark), ["lang", "n_chars"]).collect() == []


def test_written_shards_prune(text_spark, tmp_path):
    docs = text_spark.range(400).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), (F.col("id") % 20).alias("a"), (F.floor(F.col("id") / 20)).alias("b"))
    placed = sharding.hilbert_shards(docs, ["a", "b"], shards=8, bits=4)
    bounds = sharding.write_shards(docs, placed, str(tmp_path / "s"), ["a", "b"]).collect()
    assert sorted(r["rows"] for r in bounds) == [50] * 8
    # a filter on either column alone needs fewer than all shards
    assert sum(r["min_a"] <= 0 <= r["max_a"] for r in bounds) < 8 and sum(r["min_b"] <= 0 <= r["max_b"] for r in bounds) < 8
    assert text_spark.read.parquet(str(tmp_path / "s")).count() == 400


@pytest.mark.parametrize("bits", [1, 3, 6])
def test_levels_are_ranks_by_rows_and_values(text_spark, bits):
    random.seed(bits)
    values = [random.choice(["a", "a", "a", "b", "zz", None, "é", *map(str, range(200))]) for _ in range(3000)]
    docs = text_spark.createDataFrame([(v,) for v in values], "v string").repartition(7)
    counts = Counter(v for v in values if v is not None)
    wanted, n = {None: 0}, 0
    for i, v in enumerate(sorted(counts, key=lambda v: v.encode())):
        wanted[v] = int((n / sum(counts.values()) + i / len(counts)) / 2 * 2**bits)
        n += counts[v]
    found = docs.select("v", sharding.quantised(docs, "v", bits).alias("level")).distinct().collect()
    assert {r["v"]: r["level"] for r in found} == wanted


def test_few_values_have_levels_of_their_own(text_spark):
    docs = text_spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 31)).alias("v"))
    found = docs.select("v", sharding.quantised(docs, "v", 6).alias("level")).distinct().collect()
    assert len({r["level"] for r in found}) == len(found) == 32
    nothing = text_spark.createDataFrame([(None,), (None,)], "v double")
    assert [r["l"] for r in nothing.select(sharding.quantised(nothing, "v", 6).alias("l")).collect()] == [0, 0]


def test_written_shards_with_odd_columns_and_keys(text_spark, tmp_path):
    docs = text_spark.createDataFrame([(None, "a", 1, "p"), (2, None, 2, "q"), (3, "", 3, "r")], "doc_id long, text string, _shard int, _row string")
    placed = sharding.hilbert_shards(docs, ["_shard"], shards=2)
    bounds = sharding.write_shards(docs, placed, str(tmp_path / "s"), ["_shard"]).collect()
    assert sum(r["rows"] for r in bounds) == 3 and min(r["min__shard"] for r in bounds) == 1
    back = text_spark.read.parquet(str(tmp_path / "s")).select(docs.columns)
    assert Counter(map(tuple, back.collect())) == Counter(map(tuple, docs.collect()))
    twice = docs.unionByName(docs.limit(2))
    with pytest.raises(Exception, match="more than once"):
        sharding.write_shards(twice, sharding.hilbert_shards(twice, ["_shard"], shards=2), str(tmp_path / "t"), ["_shard"])


# Personal data


def test_plain_patterns():
    random.seed(0)
    for _ in range(20000):
        alphabet = random.choice(["a.@-+1", "0123456789 -", "12.@5", "+1 (2)3-.4", "ab@.c1", "0. 25"])
        text = "".join(random.choice(alphabet) for _ in range(random.randint(0, 40)))
        assert pii.plain(text) == plain_spans(text), text


@pytest.mark.parametrize(
    "text, kind, source",
    [
        ("mail jоhn.doe@exаmple.com now", "email", "jоhn.doe@exаmple.com"),
        ("to john [at] example [dot] com please", "email", "john [at] example [dot] com"),
        ("to john(at)mail.example.org please", "email", "john(at)mail.example.org"),
        ("john at example dot com.", "email", "john at example dot com"),
        ("ｊｏｅ＠ｅｘａｍｐｌｅ．ｃｏｍ", "email", "ｊｏｅ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
        ("a jo​hn@example.com b", "email", "jo​hn@example.com"),
        ("call plus one four one five five five five two six seven one now", "phone", "plus one four one five five five five two six seven one"),
        ("card four one one one one one one one one one one one one one one one ok", "card", "four one one one one one one one one one one one one one one one"),
        ("ip one nine two dot one six eight dot one dot one!", "ip", "one nine two dot one six eight dot one dot one"),
        ("10 dot 0 dot 0 dot 7", "ip", "10 dot 0 dot 0 dot 7"),
        ("at 192 dot 168 dot one dot one ok", "ip", "192 dot 168 dot one dot one"),
        ("at ten dot 192 dot 168 dot one dot 7 ok", "ip", "192 dot 168 dot one dot 7"),
        ("one dot 168 dot 0 dot 7", "ip", "one dot 168 dot 0 dot 7"),
        ("card 4111 1111 one one 11 1111 ok", "card", "4111 1111 one one 11 1111"),
        ("call +four one 555 555 2671 ok", "phone", "+four one 555 555 2671"),
        ("٤١١١ ١١١١ ١١١١ ١١١١", "card", "٤١١١ ١١١١ ١١١١ ١١١١"),
    ],
)
def test_disguises(text, kind, source):
    added = [(k, text[a:b]) for k, a, b, plain in pii.find(text) if not plain]
    assert added == [(kind, source)]
    assert f"<{kind}>" in pii.mask(text, pii.find(text)) and source not in pii.mask(text, pii.find(text))


@pytest.mark.parametrize(
    "text, source",
    [
        ("to john [at] example dot com please", "john [at] example dot com"),
        ("to john(at)example dot co dot uk please", "john(at)example dot co dot uk"),
        ("bob@example dot com", "bob@example dot com"),
        ("bob＠mail.example punkt com", "bob＠mail.example punkt com"),
        ("ana at correo dot mx", "ana at correo dot mx"),
        ("x at shop dot app, y", "x at shop dot app"),
        ("ana at correo (dot) mx", "ana at correo (dot) mx"),
        ("jo at the[dot]app", "jo at the[dot]app"),
        ("ana arroba correo.mx", "ana arroba correo.mx"),
        ("ana at correo dot com dot mx", "ana at correo dot com dot mx"),
    ],
)
def test_mixed_disguises(text, source):
    assert pii.disguised(text)
    assert [text[a:b] for k, a, b, plain in pii.find(text) if k == "email" and not plain] == [source]


@pytest.mark.parametrize("text", ["he came at some point in time", "look at knife point in town", "meet at 5 dot 30", "look at example.py", "a@b dot", "in 2019 one of 12", "call 5 one 6"])
def test_prose_without_an_address(text):
    assert pii.find(text) == []


def test_mixed_disguises_take_linear_time():
    import time

    start = time.process_time()
    for unit in ("a@b dot ", "a at b dot ", "a [at] b dot ", " dot at", "at dot dot dot ", "a@b.", "@ dot "):
        pii.find(unit * (100_000 // len(unit)))
    assert time.process_time() - start < 20


@pytest.mark.parametrize("text", ["look at this dot matrix", "meet at noon", "one two three", "see [at] the end", "", "Ñandú à la carte", "we met at example dot"])
def test_prose_is_left_alone(text):
    assert pii.find(text) == [] and pii.mask(text, []) == text


def test_plain_spans_stay():
    random.seed(9)
    pieces = ["a.b@c.de", " at ", " dot ", "com", "[at]", "(dot)", "four one ", "10.0.0.1", "+1 (017) 555-7713 ", "4111111111111111", "о", "​", " x "]
    for _ in range(3000):
        text = "".join(random.choices(pieces, k=random.randint(1, 9)))
        found = pii.find(text)
        assert [s[:3] for s in found if s[3]] == plain_spans(text), repr(text)
        assert all(0 <= a < b <= len(text) for _, a, b, _ in found)


def test_long_texts_take_linear_time():
    import time

    start = time.process_time()
    for unit in ("a", "1", "1.", "+", "+1(", " ", "@", "a@", "( at ", "a at b ", "1 dot ", "one ", " @b.c", "a@b.c", "1 one ", "one dot ", "+one "):
        pii.find(unit * (100_000 // len(unit)))
    assert time.process_time() - start < 20
    start = time.process_time()
    assert pii.find(" @b.c" * 1_000_000) == []
    assert time.process_time() - start < 20


def test_spans_of_rows(text_spark):
    rows = [*ODD_ROWS, (50, "x 10.0.0.1 y"), (51, "é a@b.cd and 4111 1111 1111 1111")]
    docs = text_spark.createDataFrame(rows, "doc_id bigint, text string")
    found = pii.personal_data(docs, masked=True).collect()
    assert Counter((r["doc_id"], tuple((s["kind"], s["start"], s["end"]) for s in r["spans"])) for r in found) == Counter(
        (k, tuple(s[:3] for s in pii.find(t))) for k, t in rows
    )
    assert {r["masked"] for r in found if r["doc_id"] == 51} == {"é <email> and <card>"}
    assert pii.personal_data(empty_docs(text_spark)).collect() == []


# Benchmark items


def random_texts(n, sizes, seed):
    random.seed(seed)
    return [(i, " ".join(random.choice("abcdefg") for _ in range(random.choice(sizes)))) for i in range(n)]


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_containment(text_spark, threshold):
    items = [*random_texts(50, [0, 1, 2, 3, 4, 5, 6, 7, 9, 40], 1), (3, "g g g g g"), (None, "a b"), (60, None), (61, " . ")]
    docs = [*random_texts(90, [0, 1, 3, 4, 6, 30, 200], 2), (None, "a b c d e f"), (5, None), (6, "  ")]
    for i, text in items[:50]:
        words = text.split()
        if words:
            words[len(words) // 2] = "changed"
        docs += [(300 + i, f"X, y! {(text or '').upper()}. z"), (400 + i, " ".join(words))]
    docs.append(docs[-1])
    left = text_spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    right = text_spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.contained(left, right, threshold=threshold).collect()
    assert {(r[0], r[1]): tuple(r)[2:] for r in found} == contained(docs, items, threshold) and len(found) == len({(r[0], r[1]) for r in found})


def test_clean_documents_stay(text_spark):
    docs = odd_docs(text_spark)
    items = text_spark.createDataFrame([(1, "Quick brown fox jumps over the LAZY dog"), (2, "nothing like this is there at all")], "item_id bigint, text string")
    left = decontaminate.clean(docs, items)
    assert left.columns == docs.columns
    assert Counter(r["doc_id"] for r in left.collect()) == Counter(k for k, _ in ODD_ROWS if k not in (1, 2))
    assert decontaminate.contained(docs, items.where("false")).collect() == []
    assert decontaminate.contained(empty_docs(text_spark), items).collect() == []


# Archives


def pages(spark):
    big = "<p>" + "same text " * 20
    rows = [(5, "http://a/5", big), (3, "http://a/3", big), (9, None, big), (None, "u", big), (1, "http://a\r\n/1", "short"), (2, "x", "short"), (7, "y", None), (8, "z", "")]
    rows += [(20, "é", "línea\r\n\r\nWARC/1.1\r\n\r\n" + "ü" * 90), (21, "q", "línea\r\n\r\nWARC/1.1\r\n\r\n" + "ü" * 90), (3, "again", big)]
    docs = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    return rows, docs.withColumn("key", F.lit("clash")).withColumn("digest", F.lit("clash")).repartition(3)


def test_round_trip(text_spark, tmp_path):
    rows, frame = pages(text_spark)
    path = str(tmp_path / "archive")
    warc.write_archive(frame, path)
    found = warc.read_archive(text_spark, path).withColumn("bytes", warc.record_bytes()).collect()
    first = {}
    for k, _, html in rows:
        if k is not None:
            first[html or ""] = min(first.get(html or "", k), k)
    wanted = []
    for k, _, html in rows:
        again = len((html or "").encode()) >= 100 and k != first[html or ""]
        wanted.append((k, len((html or "").encode()), sha(html or ""), "revisit" if again else "response", str(first[html or ""]) if again else None))
    assert Counter((r["key"], r["payload_bytes"], r["digest"], r["record_type"], r["refers_to"]) for r in found) == Counter(wanted)
    assert Counter((r["key"], bytes(r["payload"]).decode()) for r in found) == Counter((k, html or "") for k, _, html in rows)
    assert text_spark.read.parquet(f"{path}/payloads").count() == len({html or "" for _, _, html in rows})
    for r in found:
        head, _, block = bytes(r["bytes"]).partition(b"\r\n\r\n")
        length = int(re.search(rb"\r\nContent-Length: (\d+)", head).group(1))
        assert len(block) == length + 4 and block.endswith(b"\r\n\r\n")


@pytest.mark.parametrize("kind", ["string", "double"])
def test_odd_ids_keep_their_links(text_spark, tmp_path, kind):
    big = "<p>" + "same text " * 20
    ids = ["a>b", "z", "null", None, "é %3E\r\nX", "", None] if kind == "string" else [2.5, -0.1, 1e300, None, 7.0, 3.0, None]
    frame = text_spark.createDataFrame([(i, f"u{n}", big) for n, i in enumerate(ids)], f"page_id {kind}, url string, html string").repartition(3)
    path = str(tmp_path / "archive")
    warc.write_archive(frame, path)
    found = warc.read_archive(text_spark, path).withColumn("bytes", warc.record_bytes()).collect()
    first = min(i for i in ids if i is not None)
    assert Counter((r["key"], r["record_type"]) for r in found) == Counter((i, "response" if i == first else "revisit") for i in ids)
    assert {r["refers_to"] for r in found if r["key"] != first} == {str(first) if kind == "string" else repr(first)}
    names = [re.search(r"WARC-Record-ID: (.*)\r", bytes(r["bytes"]).decode()).group(1) for r in found]
    assert len(set(names)) == len(ids) and all(re.fullmatch(r"<urn:[^<>\s]*>", n) for n in names)
    assert all(bytes(r["bytes"]).count(b"WARC-Record-ID") == 1 for r in found)


def test_records_are_rebuilt_and_checked(text_spark, tmp_path):
    rows, frame = pages(text_spark)
    path = str(tmp_path / "archive")
    warc.write_archive(frame, path)
    rebuilt = warc.rebuilt(text_spark, path).collect()
    whole = {(r["header"], bytes(r["bytes"])) for r in warc.read_archive(text_spark, path).withColumn("bytes", warc.record_bytes()).collect()}
    assert {(r["header"], bytes(r["record"])) for r in rebuilt} == whole and len(rebuilt) == len(rows)
    cut = text_spark.read.parquet(f"{path}/records").withColumn("header", F.expr("encode(replace(decode(header, 'UTF-8'), 'Content-Length: ', 'Content-Length: 9'), 'UTF-8')"))
    cut.write.parquet(str(tmp_path / "bad" / "records"))
    text_spark.read.parquet(f"{path}/payloads").write.parquet(str(tmp_path / "bad" / "payloads"))
    with pytest.raises(Exception, match="record damaged"):
        warc.rebuilt(text_spark, str(tmp_path / "bad")).collect()


def test_files_hold_the_records(text_spark, tmp_path):
    rows, frame = pages(text_spark)
    warc.write_archive(frame, str(tmp_path / "archive"))
    warc.export_warc(text_spark, str(tmp_path / "archive"), str(tmp_path / "files"))
    records = []
    for file in glob.glob(str(tmp_path / "files" / "part*")):
        raw, at = open(file, "rb").read(), 0
        while at < len(raw):
            end = raw.index(b"\r\n\r\n", at)
            head = raw[at:end].decode()
            length = int(re.search(r"\r\nContent-Length: (\d+)", head).group(1))
            block = raw[end + 4 : end + 4 + length]
            at = end + 8 + length
            assert head.startswith("WARC/1.1\r\n") and raw[at - 4 : at] == b"\r\n\r\n"
            if "WARC-Type: response" in head:
                payload = block.partition(b"\r\n\r\n")[2].decode()
                assert re.search("sha256:(.*)\r", head).group(1) == sha(payload)
            records.append(head)
    assert len(records) == len(rows)


def test_damage_is_found(text_spark, tmp_path):
    path = str(tmp_path / "archive")
    warc.write_archive(pages(text_spark)[1], path)
    damaged = text_spark.read.parquet(f"{path}/payloads").withColumn("payload", F.lit(b"other"))
    damaged.write.parquet(str(tmp_path / "bad" / "payloads"))
    with pytest.raises(Exception, match="payload damaged"):
        warc.payloads(text_spark, str(tmp_path / "bad")).collect()


def test_empty_archive(text_spark, tmp_path):
    warc.write_archive(pages(text_spark)[1].where("false"), str(tmp_path / "a"))
    assert warc.read_archive(text_spark, str(tmp_path / "a")).collect() == []
