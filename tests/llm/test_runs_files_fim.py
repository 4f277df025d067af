"""Operators 11 to 13: runs of words, token id files, fill-in-the-middle; brute force and edge cases."""

import hashlib
import os
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rankfold.llm import catalog, fim, pieces, runs, token_files
from rankfold.llm.common import prepare, stored, table

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string"
LONG = " ".join(f"word{i % 997} and{i % 31}" for i in range(40_000))
ROWS = [(1, "one two three four"), (1, "one two three four"), (2, "é\n\U0001F600ü\n\nlast ß"), (3, None), (4, ""),
        (5, " \n\t "), (None, "no id here"), (None, None), (7, "x"), (8, LONG), (9, "a <P> b\nc"), (10, "\n"), (11, "a b " * 40)]
CLASH = ["n", "form", "h1", "rid", "crc", "start", "runs", "words", "h", "g", "a", "p", "n_ids", "packed"]


@pytest.fixture(scope="module")
def docs(spark):
    return stored(spark.createDataFrame(ROWS, SCHEMA).withColumns({c: F.lit("extra") for c in CLASH}), "edge3")


@pytest.fixture(scope="module")
def texts(spark):
    return dict(table(spark, SF, "documents").select("doc_id", "text").collect())


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


# ---- runs

def lyndon_by_force(s):
    return [max(j - i for j in range(i + 1, len(s) + 1) if all(s[i:j] < s[k:j] for k in range(i + 1, j)))
            for i in range(len(s))]


def runs_by_force(w, least):
    number = {}
    a = np.array([number.setdefault(x, len(number)) for x in w])
    out = []
    for q in range(1, len(a) // 2 + 1):
        k = 0
        agree = np.concatenate((a[:-q] == a[q:], [False]))
        while k < len(agree):
            if not agree[k]:
                k += 1
                continue
            b = k
            while agree[b]:
                b += 1
            length = b - k + q
            part = a[k:k + length]
            if length >= max(least, 2 * q) and not any((part[p:] == part[:-p]).all() for p in range(1, q)):
                out.append((k, length, q))
            k = b
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_lyndon_arrays_by_force():
    rng = random.Random(4)
    for _ in range(400):
        s = np.unique([rng.randrange(rng.randrange(1, 5)) for _ in range(rng.randrange(1, 22))], return_inverse=True)[1]
        assert runs.lyndon_lengths(s).tolist() == lyndon_by_force(s.tolist())


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_by_force(least):
    rng = random.Random(least)
    for _ in range(300):
        n, k = rng.randrange(1, 80), rng.randrange(1, 5)
        w = [rng.randrange(k) for _ in range(n)]
        if rng.random() < 0.5:
            a, p = rng.randrange(n), rng.randrange(1, 12)
            w = [w[i] if i < a else w[min(n - 1, a + (i - a) % p)] for i in range(n)]
        want = runs_by_force(w, least)
        assert runs.runs_of(np.array(w), least) == want
        found, kept = runs._runs(np.array(w), np.zeros(n, int), 1, (least + 1) // 2, least)
        gone = {x for s, length, q in want for x in range(s + q, s + length)}
        assert found[0] == want and np.flatnonzero(~kept).tolist() == sorted(gone)


def test_runs_query_by_force(spark, texts):
    rows = catalog.QUERIES["op11_baier_runs"](spark, SF).collect()
    assert len(rows) == len(texts)
    some = 0
    for r in rows:
        w = WORD.findall(texts[r.doc_id] or "")
        n, h = len(w), zlib.crc32(str(r.doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        want = runs_by_force(w, 12) if n < 1500 else None
        if want is None:
            continue
        best = min(want, key=lambda x: (-x[1], x[0], x[2])) if want else (None, None, None)
        gone = {x for s, length, q in want for x in range(s + q, s + length)}
        assert (r.n_runs, r.start, r.length, r.period) == (len(want), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if want else None)
        assert r.runs_sha256 == sha("".join(f"{s},{length},{q}\n" for s, length, q in want))
        assert r.collapsed_sha256 == sha(" ".join(x for i, x in enumerate(w) if i not in gone))
        some += len(want)
    assert some > 10


def test_runs_edges(docs):
    rows = runs.find_runs(docs).collect()
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append(r)
    assert len(rows) == len(ROWS) and got[1][0] == got[1][1]
    for i in (3, 4, 5, 10):
        assert (got[i][0].n_words, got[i][0].runs, got[i][0].collapsed) == (0, [], "")
    assert [tuple(x) for x in got[11][0].runs] == [(0, 80, 2)] and got[11][0].collapsed == "a b"
    assert got[2][0].collapsed == "é \U0001F600ü last ß" and got[8][0].n_words == 80_000
    assert [tuple(x) for x in got[8][0].runs] == [(0, 80_000, 61_814)] or got[8][0].runs == []
    assert runs.find_runs(docs.where("1 = 0")).collect() == []
    planted = runs.with_planted_periods(docs)
    assert planted.count() == len(ROWS) and planted.columns == ["doc_id", "text"]


# ---- token id files

def test_pack_round_trip():
    rng = np.random.default_rng(2)
    ranks = np.concatenate([rng.integers(0, 1 << b, 40) for b in (1, 8, 9, 16, 17, 24, 25, 32)]).astype(np.uint32)
    rng.shuffle(ranks)
    control, data = token_files.pack(ranks)
    size = [max(1, -(-int(r).bit_length() // 8)) for r in ranks]
    assert len(control) == len(ranks) // 4 and len(data) == sum(size)
    back, used = token_files.unpack(control, np.concatenate((data, np.array([9, 9], np.uint8))))
    assert used == len(data) and (back == ranks).all()


def test_words_encode_like_whole_texts(texts):
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path(token_files.VOCABULARY)
    whole, enc = Tokenizer.from_file(path), pieces.WordEncoder(path)
    rng = random.Random(3)
    letters = "aB'sTreVElmd09 \t\n\x0b.,!<|>²½éÉßſİıΣσñ́ \u0085­ẞ ﬁ漢\U0001F600\x00\x1c"
    odd = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(1500)]
    odd += ["<|endoftext|> x<|startoftext|>y <|ENDOFTEXT|>", "", " \n", "don't I'VE we'll x's1 ''s", "ab" * 3000]
    odd += ["".join(map(chr, range(a, a + 64))) for a in range(0, 0x3000, 64)]
    batch = odd + [t or "" for t in texts.values()]
    ids, n = enc.encode(pa.array(batch))
    at = 0
    for t, k in zip(batch, n):
        assert ids[at:at + k].tolist() == whole.encode(t, add_special_tokens=False).ids, t
        at += k
    assert at == len(ids)


def test_ids_query_by_force(spark, texts):
    import public_tokenizers
    from tokenizers import Tokenizer
    whole, start = Tokenizer.from_file(public_tokenizers.path(token_files.VOCABULARY)), 0
    rows = {r.doc_id: r for r in catalog.QUERIES["op12_ranked_bytes"](spark, SF).collect()}
    assert len(rows) == len(texts)
    for i in sorted(texts):
        ids = whole.encode(texts[i] or "", add_special_tokens=False).ids + [1]
        want = (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        assert tuple(rows[i]) == want
        start += len(ids)


@pytest.mark.parametrize("file_ids", [1, 7, 10_000])
def test_id_files_edges(spark, docs, file_ids, tmp_path):
    prepare(spark)
    folder = token_files.write_ids(docs, folder=f"{tmp_path}/ids", file_ids=file_ids)
    rows = token_files.read_ids(spark, folder).orderBy("start").collect()
    assert len(rows) == len(ROWS)
    assert [r.doc_id for r in rows] == [None, None, 1, 1, 2, 3, 4, 5, 7, 8, 9, 10, 11]
    assert [r.start for r in rows] == [sum(x.n_ids for x in rows[:i]) for i in range(len(rows))]
    enc = pieces.encoder(token_files.default_vocabulary())
    for r in rows:
        if r.doc_id is not None:
            ids, _ = enc.encode(pa.array([dict(ROWS)[r.doc_id] or ""]))
            assert np.frombuffer(r.ids, "<u4").tolist() == [*ids.tolist(), 1]
    ranks = np.fromfile(f"{folder}/ranks", "<u4")
    counts = dict(zip(*np.unique(np.concatenate([np.frombuffer(r.ids, "<u4") for r in rows]), return_counts=True)))
    assert [(-counts[i], i) for i in ranks] == sorted((-c, i) for i, c in counts.items())
    files = [f for f in os.listdir(folder) if f.endswith(".frvb")]
    assert len(files) == (len(ROWS) if file_ids == 1 else len(files)) and len(files) > (0 if file_ids > 7 else 4)
    again = token_files.write_ids(docs, folder=f"{tmp_path}/again", file_ids=file_ids)
    for f in files:                                            # a task run again writes the same bytes
        assert open(f"{folder}/{f}", "rb").read() == open(f"{again}/{f}", "rb").read()


def test_id_files_of_nothing(spark, docs):
    prepare(spark)
    assert token_files.read_ids(spark, token_files.write_ids(docs.where("1 = 0"))).collect() == []
    bare = token_files.read_ids(spark, token_files.write_ids(docs.where("doc_id IN (3, 4, 7)"), end_id=None))
    assert sorted((r.doc_id, r.n_ids) for r in bare.collect()) == [(3, 0), (4, 0), (7, 1)]


# ---- fill in the middle

def test_char_index_by_force():
    rng = random.Random(5)
    for _ in range(200):
        s = "".join(rng.choice("ab\né漢\U0001F600") for _ in range(rng.randrange(50)))
        index = fim.CharIndex(np.frombuffer(s.encode(), np.uint8))
        cuts = np.array([len(s[:i].encode()) for i in range(len(s) + 1)])
        assert index.to_byte(np.arange(len(s) + 1)).tolist() == cuts.tolist()
        assert index.to_char(cuts).tolist() == list(range(len(s) + 1))
    assert len(fim.CharIndex(np.frombuffer(b"plain text", np.uint8)).byte) == 0


@pytest.mark.parametrize("unit,percent", [("line", 100), ("char", 100), ("char", 40)])
def test_fim_by_force(spark, docs, unit, percent):
    rows = fim.transform(docs, unit=unit, fim_percent=percent)
    rows = rows.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    assert len(rows) == len(ROWS)
    known = {}
    for i, t in ROWS:
        known.setdefault(i, []).append(t or "")
    for r in rows:
        h = hashlib.sha256(f"7:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()
        h = [int(h[8 * k:8 * k + 8], 16) for k in range(4)]
        options = set()
        for t in known[r.doc_id]:
            units = re.findall(r"[^\n]*\n|[^\n]+", t) if unit == "line" else list(t)
            a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
            p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
            if not t or any(x in t for x in fim.MARKS) or h[2] % 100 >= percent:
                options.add((len(units), "plain", None, None, t, t))
            elif h[3] % 100 < 50:
                options.add((len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", t))
            else:
                options.add((len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", t))
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) in options
    assert fim.transform(docs.where("1 = 0"), unit=unit).collect() == []


def test_fim_arguments(docs):
    for bad in ({"unit": "word"}, {"marks": ("<<", "b", "c")}, {"marks": ("a", "a", "c")}):
        with pytest.raises(ValueError):
            fim.transform(docs, **bad)
