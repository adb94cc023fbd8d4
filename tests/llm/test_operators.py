"""Every corpus operator against brute force on small fixtures, with nulls, blanks, ties, repeats, clashing names and empty tables."""

import base64
import hashlib
import itertools
import math
import random
import re
import subprocess
import sys
from collections import defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from tidemark.llm import ann, chat, decontam, hilbert, langid, linededup, minhash, mixing, toxicity, warc
from tidemark.llm.common import groups, split_words
from tidemark.llm.components import components

RNG = random.Random(17)
EN, DE = "the of and to in is that for with on".split(), "der die und das nicht mit von ein auch für".split()


def prose(words, n, rng=RNG):
    return " ".join(rng.choice(words) + rng.choice(["", "", "s", "ing"]) for _ in range(n))


def words_of(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def test_split_words_and_groups():
    vocab, flat, counts = split_words(pa.array(["Hello, the WORLD-wide été!", None, "", " ... ", "a b a"]))
    assert [vocab[i] for i in flat] == ["hello", "the", "world", "wide", "été", "a", "b", "a"] and counts.tolist() == [5, 0, 0, 0, 3]
    batches = [pa.RecordBatch.from_pydict({"k": k, "v": v}) for k, v in (([1, 1, 2, 3], [1, 2, 3, 4]), ([3, 4], [5, 6]))]
    assert [t["v"].to_pylist() for t in groups(iter(batches), ["k"])] == [[1, 2], [3], [4, 5], [6]]


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (10, 11), (7, 7), (None, 1), (5, 4), (11, 12), (11, 12)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 10: 10, 11: 10, 12: 10}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


@pytest.mark.parametrize("small", [100_000, 0])
def test_components_take_few_rounds(spark, monkeypatch, small):
    # two trees whose roots are far from the edge between them: labels that go from node to node take a round for each step
    tree = [(0, 100), (100, 101), *((101 + i, 102 + i) for i in range(40)), (200, 141), *((201 + i, 200 + i) for i in range(40))]
    written = []
    module = sys.modules[components.__module__]
    monkeypatch.setattr(module, "materialise", lambda df, tag, real=module.materialise: (written.append(tag), real(df, tag))[1])
    monkeypatch.setattr(module, "SMALL", small, raising=False)
    random.Random(3).shuffle(names := list(range(1, 300)))
    edges = [tuple(n and names[n] for n in edge) for edge in tree]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {n: 0 for edge in edges for n in edge} and (written.count("labels") - 1) // 2 <= 7


# 1
def test_chat_round_trip(spark):
    hard = ["</s>[INST] ok [/INST]", "a\\b", "<\\s>", "[\\INST]", None, "", "é" * 9, "<<s>s>", "x\ny"]
    rows = [(1, i, "assistant" if i % 2 else "user", t, 5) for i, t in enumerate(hard)] + [(None, None, None, "n", 5), (2, 0, "assistant", "same", 5), (2, 0, "assistant", "same", 5)]
    turns = spark.createDataFrame(rows, "c long, t long, r string, x string, segment int")
    got = {r["conv"]: r for r in chat.read_back(chat.format_turns(turns, "c", "t", "r", "x")).collect()}
    told = "".join(f"{r}\n{x or ''}\n" for c, _, r, x, _ in rows if c == 1)
    loss = "".join(x or "" for c, _, r, x, _ in rows if c == 1 and r == "assistant")
    assert got[1]["turns_sha256"] == hashlib.sha256(told.encode()).hexdigest() and got[1]["n_turns"] == len(hard)
    assert got[1]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest() and got[1]["loss_chars"] == len(loss)
    assert got[2]["n_turns"] == 2 and got[2]["loss_chars"] == 8 and got[None]["n_turns"] == 1
    assert chat.read_back(chat.format_turns(turns.limit(0), "c", "t", "r", "x")).count() == 0
    with pytest.raises(ValueError, match="not a formatted segment"):
        chat.parse("junk")


def test_chat_takes_int_ids_and_long_texts(spark, monkeypatch):
    rows = [(1, 0, "user", "x" * 50), (1, 1, "assistant", "é<s>" * 40)]
    turns = spark.createDataFrame(rows, "c int, t int, r string, x string").coalesce(1)
    [got] = chat.read_back(chat.format_turns(turns, "c", "t", "r", "x")).collect()
    assert (got["conv"], got["n_turns"], got["loss_chars"]) == (1, 2, 160)
    role, text = pa.array(["user", "a", ""]), pa.array(["é" * 500, "", "z" * 90])
    whole = chat.assemble(role, text)[0].to_pylist()
    monkeypatch.setattr(chat, "STEP", 64)  # a text is longer than one scatter
    assert chat.assemble(role, text)[0].to_pylist() == whole


def test_texts_longer_than_a_slice(monkeypatch):
    from tidemark.llm import common

    texts = ["a b c d e f", None, "x " * 300, "", "a b c d e f"]
    batch = pa.RecordBatch.from_pydict({"id": list(range(5)), "text": texts})
    parts = list(common.text_slices(batch, "text", 10))
    assert [x for p in parts for x in p["id"].to_pylist()] == list(range(5)) and len(parts) > 2
    whole = minhash.shingles(batch["text"], 5)
    cut = [minhash.shingles(p["text"], 5) for p in parts]
    assert np.array_equal(np.concatenate([g for g, _ in cut]), whole[0]) and np.array_equal(np.concatenate([m for _, m in cut]), whole[1])


def test_conversations_begin_with_their_marker(spark):
    rows = [(c, t, "assistant" if t % 2 == c else "user", f"<s>é{t}") for c in (0, 1) for t in range(3)] + [(None, 0, "assistant", "n"), (None, 1, None, None)]
    segments = chat.format_turns(spark.createDataFrame(rows, "c long, t long, r string, x string"), "c", "t", "r", "x")
    texts, losses = defaultdict(str), defaultdict(list)
    for r in chat.conversations(segments).collect():
        texts[r["conv"]] += r["segment"]
        losses[r["conv"]].append(chat.unescape(r["segment"].encode()[r["loss_start"] : r["loss_start"] + r["loss_bytes"]].decode()))
    for conv, text in texts.items():
        assert text.startswith("<s>[INST]") and text.count("<s>") == 1
        assert chat.parse(text[3:]) == [(r or "", x or "") for c, _, r, x in rows if c == conv]
        assert losses[conv] == [x if r == "assistant" else "" for c, _, r, x in rows if c == conv]
    assert {r["conv"]: r["formatted_chars"] for r in chat.read_back(segments).collect()} == {c: len(t) for c, t in texts.items()}


# 2
def test_hilbert_index_is_a_path(spark):
    cells = [(a, b, c) for a in range(8) for b in range(8) for c in range(8)]
    df = spark.createDataFrame(cells, "a int, b int, c int")
    path = df.withColumn("h", hilbert.curve_index([F.col("a"), F.col("b"), F.col("c")], 3)).orderBy("h").collect()
    assert [r["h"] for r in path] == list(range(512))
    assert all(sum(abs(x[k] - y[k]) for k in "abc") == 1 for x, y in itertools.pairwise(path))


def test_shards_are_runs_of_equal_counts(spark):
    rows = [(i if i % 7 else None, RNG.choice(["x", "y", None]), RNG.choice([0, 5, 10**6, None]), i) for i in range(203)] + [(3, "x", 5, 0)] * 5
    df = spark.createDataFrame(rows, "id long, kind string, size long, slot int")
    got = hilbert.order_and_cut(df, "id", [hilbert.Dimension("kind"), hilbert.Dimension("size", "size")], 9).collect()
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
    assert len(got) == len(rows) and sorted(r["place"] for r in got) == list(range(len(rows)))
    assert all(sorted(s) == list(range(len(s))) for s in by.values()) and {len(s) for s in by.values()} <= {len(rows) // 9, len(rows) // 9 + 1}
    assert hilbert.order_and_cut(df.limit(0), "id", [hilbert.Dimension("kind")], 9).count() == 0


def test_slots_are_the_same_every_time(spark):
    rows = [(None, f"t{i}", 1, 1, 1) for i in range(30)] + [(7, f"u{i % 5}", 2, 2, 2) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, text string, cell int, bucket int, row int")
    cut = lambda d: sorted(map(tuple, hilbert.order_and_cut(d, "id", [hilbert.Dimension("cell")], 7).collect()), key=str)
    assert cut(df) == cut(df.repartition(3, "text")) and {r[2:5] for r in cut(df)} == {(1, 1, 1), (2, 2, 2)}


def test_shard_files_are_pruned(spark, tmp_path):
    """Files whose statistics leave a value open, along the curve and in the order of ids."""
    import pyarrow.parquet as pq

    dims = [hilbert.Dimension("a", "range", 0, 16), hilbert.Dimension("b", "range", 0, 16)]
    df = spark.createDataFrame([(i, RNG.randrange(16), RNG.randrange(16)) for i in range(2000)], "id long, a int, b int")
    hilbert.write_shards(hilbert.order_and_cut(df, "id", dims, 4), f"file://{tmp_path}/curve", 32)
    df.repartitionByRange(32, "id").write.parquet(f"file://{tmp_path}/ids")

    def met(folder):
        share = []
        for column in ("a", "b"):
            bounds = []
            for path in (tmp_path / folder).rglob("*.parquet"):
                meta = pq.ParquetFile(path).metadata
                at = next(i for i in range(meta.num_columns) if meta.schema.column(i).name == column)
                own = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
                bounds.append((min(s.min for s in own), max(s.max for s in own)))
            share.append(np.mean([low <= v <= high for v in range(16) for low, high in bounds]))
        return share

    assert max(met("curve")) < 0.5 < 0.9 < min(met("ids"))
    assert spark.read.parquet(f"file://{tmp_path}/curve").count() == 2000


# 3
@pytest.mark.parametrize(("chunk", "least"), [(16, 0), (1 << 16, 30)])
def test_warc_round_trip(spark, tmp_path, chunk, least):
    body = ["", None, "short", "a\r\n\r\nb" * 20, "é" * 100, "same" * 10, "same" * 10, "WARC/1.0\r\n\r\n"]
    rows = [(i, None if i == 1 else f"http://x/\r\n{i}", b, "k") for i, b in enumerate(body * 2)]
    path = f"file://{tmp_path}/w"
    warc.write_archive(spark.createDataFrame(rows, "id long, url string, html string, key string"), "id", "url", "html", path, least, chunk)
    got = {int(r["key"]): r for r in warc.read_records(spark, path).collect()}
    last = {}
    for i, _, b, _ in rows:
        last[(b or "").encode()] = i
    assert len(got) == len(rows)
    for i, _, b, _ in rows:
        data, r = (b or "").encode(), got[i]
        first = len(data) < least or last[data] == i
        assert (r["payload_bytes"], r["payload_digest"]) == (len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
        assert (r["record_type"], r["refers_to"]) == (("response", None) if first else ("revisit", str(last[data])))


def test_warc_ids_are_unique_and_referred_to(spark, tmp_path):
    body = "ab" + "é" * 40  # 17-byte chunks end inside a letter
    rows = [(1, body), (2, body), (3, "other"), (4, body), (4, body), (5, "twice"), (6, "twice"), (None, "none"), (None, "none"), (None, "other"), (7, None), (8, None)]
    path = f"file://{tmp_path}/w"
    warc.write_archive(spark.createDataFrame(rows, "id long, html string").withColumn("url", F.lit("u")).repartition(3), "id", "url", "html", path, chunk=17)
    heads = [h for f in sorted((tmp_path / "w").glob("*.gz")) for h, _ in warc.parse(warc.inflate(f.read_bytes()))]
    ids = [h["WARC-Record-ID"] for h in heads]
    assert len(ids) == len(set(ids))
    by_id = {h["WARC-Record-ID"]: h for h in heads}
    revisits = [h for h in heads if h["WARC-Type"] == "revisit"]
    assert sorted(h["X-Key"] for h in revisits if "X-Key" in h) == ["1", "2", "5", "7"]
    for h in revisits:
        if h["X-Refers-To-Key"] != "4":  # the largest key repeats
            target = by_id[h["WARC-Refers-To"]]
            assert (target["WARC-Type"], target["X-Key"], target["WARC-Payload-Digest"]) == ("response", h["X-Refers-To-Key"], h["WARC-Payload-Digest"])
    got = sorted(((r["key"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc.read_records(spark, path).collect()), key=str)
    size = len(body.encode())
    told = [("1", "revisit", "4", size), ("2", "revisit", "4", size), ("3", "response", None, 5), ("4", "response", None, size), ("4", "response", None, size), ("5", "revisit", "6", 5), ("6", "response", None, 5), ("7", "revisit", "8", 0), ("8", "response", None, 0), (None, "response", None, 4), (None, "response", None, 4), (None, "revisit", "3", 5)]
    assert got == sorted(told, key=str)
    warc.write_archive(spark.createDataFrame([], "id long, html string, url string"), "id", "url", "html", f"{path}0")
    assert warc.read_records(spark, f"{path}0").count() == 0


def test_warc_chunks_carry_digests():
    got = list(warc.chunks(b"abcdefg", 3))
    assert [(n, bytes(p), last) for n, p, _, last in got] == [(1, b"abc", False), (2, b"def", False), (3, b"g", True)]
    assert got[-1][2] == base64.b32encode(hashlib.sha1(b"abcdefg").digest()).decode()
    assert [last for *_, last in warc.chunks(b"", 3)] == [True]


# 4
def edits(item, passage):
    """Best (matches, -insertions) over alignments of the highest score, cell by cell."""
    best, prev = (0, 0, 0), [(0, 0, 0)] * (len(passage) + 1)
    for w in item:
        row = [(0, 0, 0)]
        for j, p in enumerate(passage, 1):
            s, m, x = prev[j - 1]
            cell = (s + 2, m + 1, x) if w == p else (s - 1, m, x)
            s, m, x = prev[j]
            cell = max(cell, (s - 1, m, x))
            s, m, x = row[j - 1]
            cell = max(cell, (s - 1, m, x - 1))
            row.append(cell if cell[0] > 0 else (0, 0, 0))
        best, prev = max(best, *row), row
    return best[1], -best[2]


def test_alignment_matches_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(30):
        item = rng.integers(0, 6, rng.integers(5, 14))
        passages = [rng.integers(0, 6, rng.integers(1, 20)) for _ in range(5)]
        assert decontam.align(item, passages) == [edits(item.tolist(), p.tolist()) for p in passages]


def test_leaks(spark):
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(RNG.choices(vocabulary, k=25))) for i in range(12)] + [(98, "too short"), (99, None)]
    pad = lambda: " ".join(RNG.choices(vocabulary, k=40))
    edited = items[1][1].split()
    for at in (3, 9, 14, 20):
        edited[at] = "new"
    broken = [w if i % 3 else "new" for i, w in enumerate(items[2][1].split())]
    docs = [(0, pad()), (1, f"{pad()} {items[0][1].upper()}! {pad()}"), (2, f"{pad()} {' '.join(edited)}"), (3, f"{' '.join(broken)} {pad()}"), (4, None), (5, ""), (None, items[0][1])]
    docs += [(100 + i, f"{pad()} {items[5][1]}") for i in range(30)]  # a passage that many texts share stays a hit in all
    df = spark.createDataFrame(docs, "id long, text string").withColumn("item", F.lit("x"))
    tests = spark.createDataFrame(items, "item long, q string")
    for block in (20_000, 5):
        got = {(r["id"], r["item"]): r["similarity"] for r in decontam.leaks(df, "id", "text", tests, "item", "q", block=block).collect()}
        assert set(got) == {(1, 0), (2, 1)} | {(100 + i, 5) for i in range(30)}
        assert got[1, 0] == 1 and got[2, 1] == pytest.approx(21 / 25)
    assert decontam.leaks(df, "id", "text", tests.limit(0), "item", "q").count() == 0
    assert decontam.leaks(df.limit(0), "id", "text", tests, "item", "q").count() == 0


def test_leaks_find_copies_with_replaced_and_inserted_words(spark):
    """Against plain alignment: every word of an item is its own, and edits stand as far apart as they can."""
    items, docs = [], []
    for size, replaced, inserted in [(18, 2, 2), (19, 2, 2), (19, 3, 1), (24, 4, 1), (5, 1, 0), (18, 3, 1), (24, 5, 1), (12, 0, 3), (8, 0, 2)]:
        own = [f"i{len(items)}w{k}" for k in range(size)]
        spots = [(2 * k + 1) * size // (2 * (replaced + inserted)) for k in range(replaced + inserted)]
        copy = [w if k not in spots[:replaced] else f"new{k}" for k, w in enumerate(own)]
        for k in reversed(spots[replaced:]):
            copy.insert(k, f"put{k}")
        docs.append((len(items), " ".join([*[f"a{k}" for k in range(40)], *copy, *[f"b{k}" for k in range(40)]])))
        items.append((len(items), " ".join(own)))
    told = {}
    for (i, text), (_, item) in zip(docs, items, strict=True):
        matched, inserted = edits(item.split(), text.split())
        if matched / (len(item.split()) + inserted) >= 0.8:
            told[i, i] = matched / (len(item.split()) + inserted)
    assert {(i, i) for i in (0, 1, 2, 3, 4, 7, 8)} == set(told)
    found = decontam.leaks(spark.createDataFrame(docs, "id long, text string"), "id", "text", spark.createDataFrame(items, "item long, text string"), "item", "text")
    assert {(r["id"], r["item"]): r["similarity"] for r in found.collect()} == pytest.approx(told)


def test_leaks_lose_no_alignment(spark):
    """Random copies with random edits, repeated rows and equal items, against plain alignment of every text with every item."""
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([6, 9, 15, 22])))) for i in range(14)]
    items.append((50, items[0][1]))
    docs = []
    for i in range(60):
        copy = rng.choice(items)[1].split()
        for _ in range(rng.randint(0, 4)):
            k = rng.randrange(len(copy))
            copy[k : k + rng.randint(0, 1)] = rng.choice([[], ["new"], [rng.choice(vocabulary)]])
        docs.append((i, " ".join([*rng.choices(vocabulary, k=rng.randint(0, 25)), *copy, *rng.choices(vocabulary, k=rng.randint(0, 25))])))
    docs.append(docs[3])
    told = defaultdict(int)
    for i, text in docs:
        for k, item in items:
            matched, inserted = edits(item.split(), text.split())
            told[i, k] += matched / (len(item.split()) + inserted) >= 0.8 - 1e-9
    for block in (20_000, 4):
        found = defaultdict(int)
        for r in decontam.leaks(spark.createDataFrame(docs, "id long, text string"), "id", "text", spark.createDataFrame(items, "item long, text string"), "item", "text", block=block).collect():
            found[r["id"], r["item"]] += 1
        assert found == {k: n for k, n in told.items() if n}


def test_leaks_find_short_items_word_for_word(spark):
    items = [(1, "Alpha"), (2, "beta gamma"), (3, "one two three four"), (4, "?"), (5, None)]
    docs = [(0, "x alpha. y"), (1, "beta, gamma"), (2, "beta x gamma"), (3, "zero one two three four five"), (4, "one two three x four"), (5, "one two three five"), (6, "gamma beta")]
    found = decontam.leaks(spark.createDataFrame(docs, "id long, text string"), "id", "text", spark.createDataFrame(items, "item long, text string"), "item", "text")
    assert sorted((r["id"], r["item"], r["similarity"]) for r in found.collect()) == [(0, 1, 1.0), (1, 2, 1.0), (3, 3, 1.0)]


# 5
def test_language_backoff(spark):
    rows = [(i, prose(EN if i % 2 else DE, 30), "en" if i % 2 else "de", 1) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, text string, lang string, score int")
    model = langid.train(df, "text", "lang", "id")
    extra = spark.createDataFrame([(1000, None), (1001, ""), (1002, "12 !!"), (1003, "thating ofing withs"), (1004, "nichting undings"), (1003, "thating ofing withs")], "id long, text string")
    got = [(r["id"], r["lang_pred"], r["score"]) for r in langid.identify(df.select("id", "text", "score").unionByName(extra, allowMissingColumns=True), model).collect()]
    assert len(got) == 126 and all(0 <= s <= 1 for *_, s in got)
    assert sum(lang == ("en" if i % 2 else "de") for i, lang, _ in got if i < 120) >= 119
    assert dict((i, lang) for i, lang, _ in got if i >= 1000) == {1000: "und", 1001: "und", 1002: "und", 1003: "en", 1004: "de"}
    # by counting: a known word has its own log frequency; an unseen one the mean of its longest n-grams that occur
    counts = {n: {x: defaultdict(int) for x in ("de", "en")} for n in (0, 4, 3, 2, 1)}
    for _, text, lang, _ in rows:
        for w in words_of(text):
            counts[0][lang][w] += 1
            for n in langid.ORDERS:
                marked = f"^{w}$" if n > 1 else w
                for i in range(len(marked) - n + 1):
                    counts[n][lang][marked[i : i + n]] += 1

    def told(n, token):
        kinds = len(set(counts[n]["de"]) | set(counts[n]["en"]))
        return [math.log((counts[n][x].get(token, 0) + 0.5) / (sum(counts[n][x].values()) + 0.5 * (kinds + 1))) for x in ("de", "en")]

    assert len(model.keys[0]) == len(set(counts[0]["de"]) | set(counts[0]["en"]))
    assert np.allclose(langid.word_scores(model, ["nicht", "thezz"]), [told(0, "nicht"), np.mean([told(4, g) for g in ("^the", "thez", "hezz", "ezz$") if any(g in counts[4][x] for x in counts[4])], axis=0)], atol=1e-5)
    assert np.allclose(langid.word_scores(model, ["qxq"]), 0) or not any(c in counts[1][x] for c in "qx" for x in ("de", "en"))
    tied = langid.train(spark.createDataFrame([(1, "same", "b"), (2, "same", "a")], "id long, text string, lang string"), "text", "lang", "id")
    assert langid.score_texts(tied, pa.array(["same"]))[0] == ["a"]
    many = spark.range(40_000).selectExpr("id", "concat('w', id) AS text", "if(id % 2 = 0, 'a', 'b') AS lang")
    assert len(langid.train(many, "text", "lang", "id", max_rows=50_000).keys[0]) == 40_000
    empty = langid.train(df.limit(0), "text", "lang", "id")
    assert {r["lang_pred"] for r in langid.identify(df, empty).collect()} == {"und"}


# 6
def test_nearest_is_exact(spark):
    rng = np.random.default_rng(5)
    vectors = [rng.normal(size=8).astype(np.float32).tolist() for _ in range(150)]
    rows = [(i, v, 0) for i, v in enumerate(vectors)] + [(200 + i, vectors[3], 0) for i in range(40)]
    rows += [(300, None, 0), (301, [], 0), (302, [0.0] * 8, 0), (303, [float("nan")] * 8, 0), (304, [1.0] * 5, 0), (None, vectors[0], 0), (305, [None] * 8, 0), (7, vectors[7], 0), (320, [1e-40] * 8, 0)]
    df = spark.createDataFrame(rows, "id long, v array<float>, rank int")
    got = defaultdict(list)
    for r in ann.nearest(df, "id", "v", F.col("id") % 20 == 0, k=20, block=4).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    pool = {i: np.array(v, np.float32).astype(float) for i, v, _ in rows if i is not None and v and len(v) == 8 and None not in v and np.isfinite(v).all() and any(v)}
    queries = [i for i in pool if i % 20 == 0]
    assert set(got) == set(queries)
    for q in queries:
        score = {i: float(ann.exact(pool[q][None], v[None])[0]) for i, v in pool.items() if i != q}
        assert got[q] == [(n, i, score[i]) for n, i in enumerate(sorted(score, key=lambda i: (-score[i], i))[:20], 1)]
    assert ann.nearest(df.limit(0), "id", "v", F.col("id") % 20 == 0).count() == 0


# 7
def told_toxicity(model, margins, text):
    words = words_of(text)
    means = [np.mean(margins[toxicity.subwords([w])[0]]) for w in words]
    return 1 / (1 + math.exp(-(sum(means) / max(1, len(words)) + model.bias[1] - model.bias[0])))


def test_toxicity_sample_is_bounded_and_whole(spark):
    docs = spark.createDataFrame([(i, "long " * (i + 1), 1) for i in range(200)] + [(None, "x", 1), (5, None, 1), (7, "again", 1)], "id long, text string, y int")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(3, None), (4, 7), (None, 1)], "id long, y int")
    texts, y = toxicity.sample(docs, "id", "text", labels, "id", "y")
    assert len(texts) == 201 and y.sum() == 101 and sorted(len(t) for t in texts)[-1] == 1000
    few, _ = toxicity.sample(docs, "id", "text", labels, "id", "y", max_rows=20)
    assert 10 <= len(few) <= 80 and set(few) <= set(texts)
    assert toxicity.sample(docs.limit(0), "id", "text", labels, "id", "y")[0] == []


def test_toxicity_finds_unseen_misspellings(spark):
    bad = ["blockhead", "nitwitted"]
    toxic = lambda n: " ".join([*prose(EN, n).split(), RNG.choice(bad), *prose(EN, n).split(), RNG.choice(bad)])
    texts = [toxic(RNG.randint(3, 40)) if i % 2 else prose(EN, RNG.randint(5, 200)) for i in range(300)]
    model = toxicity.train(texts, np.array([i % 2 for i in range(300)]))
    rows = [(0, f"{prose(EN, 20)} blokhead nitwited {prose(EN, 20)}"), (1, prose(DE, 300)), (2, None), (3, ""), (4, "..."), (0, "blockheads")]
    df = spark.createDataFrame(rows, "id long, text string").withColumn("score", F.lit(9))
    scored = toxicity.score(df, "id", "text", model).collect()
    got = [(r["id"], r["score"]) for r in scored]
    # brute force: every word the mean of its n-grams, every text the mean of its words
    margins = model.margins()
    for (_, text, _), (_, found) in zip(sorted(df.collect(), key=str), sorted(got, key=str), strict=False):
        assert any(abs(s - told_toxicity(model, margins, text)) < 1e-9 for _, s in got)
    assert len(got) == 6 and all(0 <= s <= 1 for _, s in got)
    assert all((s >= 0.7) == (i == 0) for i, s in got)
    assert toxicity.score_texts(toxicity.train([], np.array([])), pa.array(["a"])).tolist() == [pytest.approx(0)]


# 8
def test_jaccard_matches_brute_force(spark):
    vocabulary = [f"w{i}" for i in range(400)]
    docs, key = [], 0
    for _ in range(25):
        base = RNG.choices(vocabulary, k=RNG.randint(60, 120))
        for _ in range(RNG.randint(1, 9)):
            copy = list(base)
            for _ in range(RNG.choice([0, 1, 2, 4])):
                copy[RNG.randrange(len(copy))] = "new"
            docs.append((key, " ".join(copy)))
            key += 1
    docs += [(900, "one two"), (901, "One, two"), (902, None), (903, ""), (904, "!!"), (905, "one two three"), (0, docs[0][1])]
    sets = []
    for _, t in docs:
        w = words_of(t)
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    links, near = defaultdict(int), defaultdict(set)
    for i, j in itertools.combinations(range(len(docs)), 2):
        if sets[i] and sets[j] and len(sets[i] & sets[j]) * 5 >= 4 * len(sets[i] | sets[j]):
            links[i] += 1
            links[j] += 1
            near[i].add(j)
            near[j].add(i)
    df = spark.createDataFrame([*docs, (None, "one two")], "id long, text string").withColumn("node", F.lit(1))
    rows = minhash.jaccard_classes(df, "id", "text").collect()
    assert len(rows) == len(docs) + 1
    got = {r["id"]: r for r in rows}
    for i, (k, _) in enumerate(docs):
        group, todo = {i}, [i]
        while todo:
            more = near[todo.pop()] - group
            group |= more
            todo += more
        assert (got[k]["n_links"], got[k]["class_id"]) == (links[i], min(docs[j][0] for j in group))
    assert minhash.jaccard_classes(df.limit(0), "id", "text").count() == 0


def test_jaccard_blocks_lose_no_link(spark, monkeypatch):
    base = [f"w{i}" for i in range(100)]
    docs = [(i, " ".join([*base[: i % 50], f"x{i}", *base[i % 50 + 1 :]])) for i in range(60)]
    df = spark.createDataFrame(docs, "id long, text string")
    whole = {tuple(r) for r in minhash.jaccard_classes(df, "id", "text").collect()}
    monkeypatch.setattr(minhash, "BLOCK", 7)
    assert {tuple(r) for r in minhash.jaccard_classes(df, "id", "text").collect()} == whole
    assert {r[1] for r in whole} == {0}


def test_banding_reaches_its_recall():
    bands, rows = minhash.banding(0.8, 0.999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.999 and bands * rows <= minhash.HASHES


# 9
@pytest.mark.parametrize("least", [1, 4])
def test_line_runs_match_brute_force(spark, least):
    lines = ["a", "b", "c\td", " e f  g", "", "h i ", "unique"]
    rows = [(i, "\n".join(RNG.choice(lines) + (str(RNG.random()) if RNG.random() < 0.1 else "") for _ in range(RNG.randint(1, 14)))) for i in range(40)] + [(90, None), (91, "")]
    cut = [t.split("\n") if t is not None else [] for _, t in rows]
    gone = [set() for _ in rows]
    at = defaultdict(list)
    for i, own in enumerate(cut):
        for k, line in enumerate(own):
            best = 0
            for a, b in at[line]:
                n = 0
                while k + n < len(own) and b + n < len(cut[a]) and own[k + n] == cut[a][b + n]:
                    n += 1
                best = max(best, n)
            if best and sum(len(x.split()) for x in own[k : k + best]) >= least:
                gone[i].update(range(k, k + best))
            at[line].append((i, k))
    df = spark.createDataFrame(rows, "id long, text string").withColumns({"n_lines": F.lit(-1), "line": F.lit("x"), "uid": F.lit(1), "runs": F.lit(2), "row": F.lit(3)})
    got = {r["id"]: r for r in linededup.remove_repeated_runs(df, "id", "text", least).collect()}
    assert len(got) == len(rows) and sum(map(len, gone)) > 0
    for (k, t), own, out in zip(rows, cut, gone, strict=True):
        assert got[k]["text"] == (None if t is None else "\n".join(x for i, x in enumerate(own) if i not in out))
        assert (got[k]["n_lines"], got[k]["n_removed"]) == (len(own), len(out))
    assert linededup.remove_repeated_runs(df.limit(0), "id", "text").count() == 0


# 10
def test_mixing_meets_targets(spark):
    rows = [(i, prose(EN if i % 3 else DE, RNG.randint(5, 60))) for i in range(200)] + [(500, None), (501, ""), (None, "the of"), (3, "the of")]
    docs = spark.createDataFrame(rows, "id long, text string").withColumn("p", F.lit(0)).withColumn("tokens", F.lit("x"))
    labels = spark.createDataFrame([(i, "en" if i % 3 else "de") for i in range(100)] + [(7, None), (None, "en")], "id long, kind string")
    weights = {"de": 0.6, "en": 0.4}
    model = mixing.fit(docs, "id", "text", labels, "id", F.col("kind"), ["de", "en"])
    scored = mixing.posteriors(docs, "id", "text", model).persist()
    for r in scored.collect():
        assert sum(r["p"]) == pytest.approx(1)
        if r["id"] is not None and r["id"] < 200 and r["id"] != 3:
            assert r["tokens"] == len(words_of(rows[r["id"]][1])) and (r["p"][0] > 0.5) == (r["id"] % 3 == 0)
    out = mixing.mix(docs, "id", "text", labels, "id", F.col("kind"), weights).collect()
    total = sum(r["tokens"] for r in out)
    for i, d in enumerate(sorted(weights)):
        assert sum(r["tokens"] * r["rate"] * r["p"][i] for r in out) == pytest.approx(weights[d] * total, rel=1e-4)
    assert len(out) == len(rows) and all(r["rate"] >= 0 for r in out)
    assert mixing.mix(docs.limit(0), "id", "text", labels, "id", F.col("kind"), weights).count() == 0
    assert {tuple(r["p"]) for r in mixing.mix(docs, "id", "text", labels.limit(0), "id", F.col("kind"), weights).collect()} == {(0.5, 0.5)}


@pytest.mark.parametrize(("rows", "weights"), [
    ([(50, (0.9, 0.1))] * 20 + [(30, (0.2, 0.8))] * 9, {"a": 0.5, "b": 0.5}),
    ([(40, (0.95, 0.05))] * 20, {"a": 0.01, "b": 0.99}),  # no rates meet these targets
    ([(7, (0.3, 0.7))], {"a": 0.9, "b": 0.1}),
    ([(10, (1.0, 0.0)), (10, (0.6, 0.4)), (0, (0.5, 0.5))], {"a": 0.2, "b": 0.8}),
])
def test_rates_are_nonnegative_least_squares(spark, rows, weights):
    """Against coordinate descent on the same squares."""
    scored = spark.createDataFrame([(t, list(p)) for t, p in rows], "tokens long, p array<double>")
    found = mixing.fit_rates(scored, ["a", "b"], weights)
    a = np.array([[t * x for x in p] for t, p in rows]).T
    x = np.ones(len(rows))
    for _ in range(20_000):
        for i in range(len(rows)):
            if a[:, i].any():
                x[i] = max(0.0, x[i] - a[:, i] @ (a @ x - found.targets) / (a[:, i] @ a[:, i]))
    told, start = ((a @ x - found.targets) ** 2).sum(), ((a.sum(axis=1) - found.targets) ** 2).sum()
    rates = np.array([r[0] for r in scored.select(mixing.rate(found.multipliers)).collect()])
    assert np.allclose(a @ rates, found.reached) and (rates >= 0).all()
    reached = ((a @ rates - found.targets) ** 2).sum()
    total = sum(t for t, _ in rows)
    assert reached <= start and math.sqrt(reached) <= math.sqrt(told) + 1e-4 * total and found.residual <= 1e-5


def test_posteriors_are_compiled_and_the_same_word_by_word(spark):
    rng = random.Random(29)
    texts = [None, "", " ... ", "The cat SAT on 3 mats.", "The cat SAT on 3 mats.", "\u00c9t\u00e9\tfoo-bar", *(prose(EN, rng.randint(1, 60), rng) for _ in range(20))]
    rows = [(i if i % 5 else None, t, 1.0) for i, t in enumerate(texts)] + [(7, "cat", 1.0), (7, "cat", 1.0)]
    docs = spark.createDataFrame(rows, "id long, t string, tokens double")
    model = mixing.Classifier([0.3, -0.2], [[rng.gauss(0, 5) if f % 3 else 0.0 for f in range(mixing.FEATURES)] for _ in range(2)])
    got = mixing.posteriors(docs, "id", "t", model)
    assert "lambda" not in got._jdf.queryExecution().executedPlan().toString()
    plain = docs.select("id", "t", mixing._features(F.col("t")))
    want = []
    for key, text, features in plain.collect():
        logits = [b + sum(round(w[f], 6) for f in features) / max(1, len(features)) for b, w in zip(model.bias, model.weights, strict=True)]
        odds = [math.exp(x) for x in logits]
        want.append((key or -1, len(words_of(text)), [pytest.approx(x / sum(odds), abs=1e-9) for x in odds]))
    mine = sorted(((r["id"] or -1, r["tokens"], r["p"]) for r in got.collect()), key=lambda r: (r[0], r[1], r[2][0]))
    assert mine == sorted(want, key=lambda r: (r[0], r[1], r[2][0].expected)) and len(mine) == len(rows)


def test_copies_keep_the_expected_count(spark):
    got = [r["n"] for r in spark.range(4000).select(mixing.copies(F.col("id"), F.lit(1.3)).alias("n")).collect()]
    assert set(got) == {1, 2} and math.isclose(sum(got) / 4000, 1.3, abs_tol=0.03)


def test_pipeline_stages(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    vocabulary = [f"{a}{b}" for a in EN for b in ("ab", "ed", "ous", "ly", "ness")]
    item = " ".join(RNG.choices(vocabulary, k=25))
    docs = [(i, " ".join(RNG.choices(vocabulary, k=60)), "en", f"s{i % 3}", 1) for i in range(60)]
    docs += [(100, docs[0][1], "en", "s0", 1), (101, f"{item} {prose(EN, 20)}", "en", "s1", 1), (102, "12 34", "en", "s1", 1), (103, None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, schema).write.parquet(f"file://{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id long, quality int, toxic int").write.parquet(f"file://{tmp_path}/labels.parquet")
    here, left = f"file://{tmp_path}", spark.createDataFrame(docs, schema)
    kept = []
    for name, stage in pipeline.STAGES:
        left = stage(spark, left, here)
        assert name == "shard" or left.columns == list(pipeline.COLUMNS)
        kept.append({r["doc_id"] for r in left.select("doc_id").collect()})
    assert kept[0] == {*range(60), 100, 101} and kept[1] == {*range(60), 101} and kept[2] == set(range(60)) and kept[4] == kept[3]
    assert {"shard", "slot"} <= set(left.columns)


def test_pipeline_examines_rows_without_id(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    words = [f"w{i}" for i in range(900)]
    item, *texts = (" ".join(RNG.sample(words, 60)) for _ in range(5))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    docs = [(None, f"{texts[0]} {item}"), (7, f"{item} {texts[1]}"), (None, texts[1]), (None, texts[2]), (5, texts[2]), (None, f"{texts[3]} tail"), (None, texts[3]), (None, None), (None, None)]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
    clean = [(r["doc_id"], r["text"]) for r in pipeline.remove_benchmark(spark, df, f"file://{tmp_path}").collect()]
    assert sorted(clean, key=str) == sorted(docs[2:], key=str)
    kept = [(r["doc_id"], r["text"]) for r in pipeline.join_near_copies(spark, df, "").collect()]
    assert len(kept) == 7 and {docs[0], docs[1], docs[2], docs[4]} < set(kept) and docs[3] not in kept
    assert kept.count((None, None)) == 2 and sum(x in kept for x in docs[5:7]) == 1


def test_pipeline_decides_by_row_where_an_id_repeats(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    one, two = (" ".join(RNG.sample([f"w{i}" for i in range(900)], 60)) for _ in range(2))
    docs = [(5, one), (2, two), (5, f"{two} tail"), (5, one), (6, f"{one} tail"), (8, "!!"), (8, "!!"), (8, "??")]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
    kept = sorted((r["doc_id"], r["text"]) for r in pipeline.join_near_copies(spark, df, "").collect())
    assert kept == sorted([(5, one), (2, two), (8, "!!"), (8, "??")])


def test_queries_match_their_sql(spark, tmp_path):
    """Nulls, blanks, short and repeated texts; DuckDB reads the same files."""
    duckdb = pytest.importorskip("duckdb")
    from tidemark.llm import queries

    rng = random.Random(3)
    base = [prose(EN, n, rng) for n in (40, 60, 3, 90)]
    edited = [" ".join([*t.split()[:-1], "zz"]) for t in base]
    block = "\n".join(prose(DE, 9, rng) for _ in range(4))
    texts = [*base, *edited, base[1], f"{base[0]}\n{block}\n\ntail", f"head\n{block}", f"{block}\n{block}", "", " ", None, "..."]
    vectors = [[rng.choice([-1.0, 0.5, 2.0]) for _ in range(4)] for _ in range(60)] + [None, [0.0] * 4, [None, 1.0, 1.0, 1.0], [float("nan")] * 4]
    turns = [(c, t, ("user", "assistant", "system", None)[(c + t) % 4], rng.choice(["<s>a", "b\\[INST]", "é\n", None, "[/INST]</s>"])) for c in range(5) for t in range(4)]
    tables = {
        "documents": spark.createDataFrame([(i, t, "en", "web", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long"),
        "pages": spark.createDataFrame([(i, "u", x) for i, x in enumerate(["<a>", None, "é" * 50, "<a>", "", "z" * 70000, "<a>"])], "page_id long, url string, html string"),
        "embeddings": spark.createDataFrame([(i, v, 0) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, label int"),
        "conversations": spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"),
    }
    con = duckdb.connect()
    for name, table in tables.items():
        table.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    told = queries.oracle_sql()
    assert set(told) <= set(queries.queries())
    for name, statement in told.items():
        found = con.execute(statement)
        columns = [c[0] for c in found.description]
        got = queries.queries()[name](spark, str(tmp_path))
        assert sorted(columns) == sorted(got.columns), name
        assert sorted(map(repr, found.fetchall())) == sorted(repr(tuple(r[c] for c in columns)) for r in got.collect()), name


WORKER = """
import pickle, sys
import pyarrow as pa
from pathlib import Path

def own_mb():
    return sum(int(x.split()[1]) for x in Path("/proc/self/smaps_rollup").read_text().splitlines() if x.startswith("Pss_Anon")) // 1024

run = pickle.loads(Path(sys.argv[1]).read_bytes())
table = pa.ipc.open_file(pa.memory_map(sys.argv[2]))
list(run(iter([table.get_batch(0).slice(0, 10)])))
before = own_mb()
for _ in run(iter([table.get_batch(0)])):
    pass
print(own_mb() - before)
"""


def test_workers_keep_no_memory_of_a_task(spark, monkeypatch, tmp_path):
    """What Spark's workers run over batches of texts, each in a process of its own: afterwards it is about as large as before."""
    if not Path("/proc/self/smaps_rollup").exists():
        pytest.skip("memory can't be read here")
    ran, plain = [], DataFrame.mapInArrow
    monkeypatch.setattr(DataFrame, "mapInArrow", lambda self, f, *a, **b: (ran.append(f), plain(self, f, *a, **b))[1])
    few = spark.createDataFrame([(i, prose(EN if i % 2 else DE, 30), "en" if i % 2 else "de") for i in range(20)], "id long, text string, lang string")
    langid.identify(few, langid.train(few, "text", "lang", "id"))
    minhash.jaccard_classes(few, "id", "text")
    decontam.leaks(few, "id", "text", few.limit(3), "id", "text")
    words = [f"{w}{i}" for i in range(3000) for w in EN[:4]]
    batch = pa.RecordBatch.from_pydict({"id": list(range(8000)), "text": [" ".join(RNG.choices(words, k=400)) for _ in range(8000)], "lang": ["en"] * 8000})
    with pa.ipc.new_file(str(tmp_path / "batch"), batch.schema) as out:
        out.write_batch(batch)
    for over_texts in (*ran[:3], *ran[-2:]):  # counts, scores, signatures, seeds, alignments
        (tmp_path / "run").write_bytes(cloudpickle.dumps(over_texts))
        grown = subprocess.run([sys.executable, "-c", WORKER, str(tmp_path / "run"), str(tmp_path / "batch")], capture_output=True, text=True, check=True).stdout
        assert int(grown) < 20


def test_empty_tables_start_no_worker(spark):
    few = spark.createDataFrame([(1, "a b c")], "id long, text string")
    found = decontam.leaks(few, "id", "text", few.where("id < 0"), "id", "text")
    nodes = spark.range(1).selectExpr("cast('a' as binary) node", "cast('a' as binary) label", "cast('a' as binary) least", "array(id) bands")
    meets = minhash._blocks(nodes.select("node", "label"), nodes.select("node", "least"), nodes)[1]
    for table, types in ((found, ["bigint", "bigint", "double", "bigint", "bigint"]), (meets, ["binary", "int", "int"])):
        assert [t for _, t in table.dtypes] == types and not table.collect()
        assert "ExistingRDD" not in table._jdf.queryExecution().toString()
