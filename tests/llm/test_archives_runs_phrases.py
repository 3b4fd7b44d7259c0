"""WARC archives, periodic runs and collocations against plain versions and on odd rows; the SQL of this folder's queries."""

import base64
import gzip
import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from cellstream.llm import collocations, periodic_runs, warc
from cellstream.llm.common import stored
from cellstream.llm.queries import ORACLE_SQL, QUERIES, planted_periods

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        if f.endswith(".parquet"):
            con.execute(f"create view {f[:-8]} as select * from '{SF}/{f}'")
    got = QUERIES[name](spark, SF)
    found = con.execute(ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(d[0] for d in found.description)
    order = [d[0] for d in found.description]
    assert sorted(map(str, (tuple(r) for r in got.select(order).collect()))) == sorted(map(str, found.fetchall()))


# Archives

PAGES = "page_id bigint, url string, html string, refers_to string, payload_digest string"


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def archived(rows, least=0):
    """page_id, bytes, digest, type and what is referred to, by plain Python."""
    first = {}
    for i, html in rows:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    out = []
    for i, html in rows:
        n = len((html or "").encode())
        to = first.get(html or "")
        revisit = i is not None and to < i and n >= least
        out.append((i, n, digest(html), "revisit" if revisit else "response", to if revisit else None))
    return sorted(map(str, out))


def pages(r, n=200):
    rows = [(i, "".join(r.choice("\r\n\r\nab é<") for _ in range(r.choice([0, 1, 5, 63, 64, 65, 200, 900]))) if i % 11 else None) for i in range(n)]
    rows += [(n + i, rows[r.randrange(n)][1]) for i in range(n)] + [(5, rows[5][1]), (5, "other"), (None, rows[8][1]), (None, "alone"), (-3, rows[9][1])]
    return rows


@pytest.mark.parametrize("least", [0, 60])
def test_archives_round_trip(spark, tmp_path, least):
    rows = pages(random.Random(least))
    t = spark.createDataFrame([(i, "http://x/\r\ny" if i != 3 else None, h, "clash", "clash") for i, h in rows], PAGES).repartition(5)
    path = str(tmp_path / "warc")
    warc.write(t, path, least=least, size=64)
    records = stored(warc.read_records(spark, path), "records")
    got = warc.resolved(records)
    assert {r["matches"] for r in got.collect()} == {True}
    assert sorted(str(tuple(r)) for r in got.select(warc.page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", warc.page_of("refers_to").alias("to")).collect()) == archived(rows, least)
    # Lengths as an independent reader takes them, and payloads chunk by chunk.
    n = 0
    for f in (f for f in os.listdir(path) if f.startswith("part")):
        data, at = gzip.open(f"{path}/{f}").read(), 0
        while at < len(data):
            head, _, _ = data[at:].partition(b"\r\n\r\n")
            assert head.startswith(b"WARC/1.1\r\nWARC-Type: ")
            at += len(head) + 4 + int(re.search(rb"Content-Length: (\d+)", head)[1])
            assert data[at : at + 4] == b"\r\n\r\n"
            at, n = at + 4, n + 1
    assert n == len(rows)
    chunks = defaultdict(list)
    for r in warc.read_chunks(spark, path).where("record_type = 'response'").collect():
        chunks[r["record_id"]].append((r["chunk_no"] or 0, bytes(r["data"] or b"")))
    whole = {k: b"".join(d for _, d in sorted(v)) for k, v in chunks.items()}
    assert whole["<urn:page:200>" if "<urn:page:200>" in whole else "<urn:page:1>"] == (dict(rows)[200 if "<urn:page:200>" in whole else 1] or "").encode()


def test_archives_of_huge_payloads_and_no_pages(spark, tmp_path):
    big = random.Random(1).randbytes(200_000).hex() * 5
    t = spark.createDataFrame([(1, "u", big, None, None), (2, "u", big, None, None)], PAGES)
    chunk = [len(r["data"]) for r in warc.record_table(t, ["page_id"], "html").orderBy("page_id", "chunk_no").collect()]
    assert max(chunk) == warc.SIZE and sum(chunk) == 2 * len(big)
    warc.write(t, str(tmp_path / "w"))
    got = sorted(map(tuple, warc.resolved(stored(warc.read_records(spark, str(tmp_path / "w")), "r")).select("record_type", "payload_bytes", "payload_digest").collect()))
    assert got == [(kind, len(big), digest(big)) for kind in ("response", "revisit")]
    warc.write(t.where("false"), str(tmp_path / "none"))
    assert warc.read_records(spark, str(tmp_path / "none")).count() == 0


def test_archives_of_other_writers(spark, tmp_path):
    body = "HTTP/1.1 200 OK\r\nX: y\r\n\r\nline\r\nline\r\n\r\n"
    text = "".join(f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:{i}>\r\nContent-Type: {of}\r\nContent-Length: {len(b)}\r\n\r\n{b}\r\n\r\n" for i, (kind, of, b) in enumerate([("warcinfo", "application/warc-fields", "a: b\r\n"), ("response", "application/http; msgtype=response", body), ("metadata", "text/plain", "")]))
    with gzip.open(tmp_path / "a.warc.gz", "wb") as f:
        f.write(text.encode())
    got = [(r["record_type"], r["payload_bytes"]) for r in warc.read_records(spark, str(tmp_path / "a.warc.gz")).collect()]
    assert got == [("warcinfo", 6), ("response", 14), ("metadata", 0)]
    with gzip.open(tmp_path / "b.warc.gz", "wb") as f:
        f.write(text.encode()[:150])
    with pytest.raises(Exception, match="ends within a record"):
        warc.read_records(spark, str(tmp_path / "b.warc.gz")).collect()


# Runs


def runs_by_force(words, least=12, repeats=2):
    n, out = len(words), {}
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, repeats * q):
                out.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in out.items())


@pytest.mark.parametrize("seed", range(4))
def test_runs_against_brute_force(seed):
    r = random.Random(seed)
    for _ in range(250):
        texts = []
        for _ in range(r.randint(1, 4)):
            words = [r.choice("abcde"[: r.choice([1, 2, 3, 5])]) for _ in range(r.choice([0, 1, 5, 20, 60, 150]))]
            nested = [r.choice("abc") for _ in range(r.randint(1, 6))]
            for _ in range(r.randint(0, 4)):
                nested = (nested * r.randint(1, 5) + nested[: r.randint(0, len(nested))] + [r.choice("abcd")] * r.randint(0, 1))[:200]
            at = r.randint(0, len(words))
            texts.append((words[:at] + nested + words[at:])[:300])
        least = r.choice([2, 3, 12])
        of, *found = periodic_runs.runs_of([[w.encode() for w in t] for t in texts], least)
        got = [[] for _ in texts]
        for i, *run in zip(of.tolist(), *(f.tolist() for f in found)):
            got[i].append(tuple(run))
        assert got == [runs_by_force(t, least) for t in texts]


def test_runs_of_odd_rows(spark):
    rows = [(None, "a " * 30, 1), (1, None, 1), (2, "", 1), (3, " \t\n", 1), (4, "x y z é " * 20, 1), (4, "x y z é " * 20, 1), (5, "one two three", 1), (6, "loop " * 50_000 + "end", 1)]
    got = sorted((tuple(r) for r in periodic_runs.collapsed(spark.createDataFrame(rows, "doc_id long, text string, runs int"), keep=("doc_id", )).collect()), key=str)
    assert got == sorted([
        (None, [(0, 30, 1)], "a"), (1, [], ""), (2, [], ""), (3, [], ""), (4, [(0, 60, 3)], "x y z é"), (4, [(0, 60, 3)], "x y z é"), (5, [], "one two three"), (6, [(0, 50_000, 1)], "loop end"),
    ], key=str)
    assert periodic_runs.collapsed(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_query_of_runs_against_brute_force(spark):
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op12_periodic_runs"](spark, SF).collect()}
    texts = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    assert len(got) == len(texts)
    planted = {r["doc_id"]: r["text"] for r in planted_periods(spark.read.parquet(f"{SF}/documents.parquet")).collect()}
    for doc_id, text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if n > 1500:
            continue
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            assert planted[doc_id] == " ".join(words)
        runs = runs_by_force(words)
        dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
        s, m, q = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None, None, None)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        assert got[doc_id] == (len(runs), s, m, q, 1000 * m // q if runs else None, sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


# Phrases


def phrases_by_force(docs, least, top=2000, covered=80):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n, out = defaultdict(Counter), Counter(), []
    for lang, text in docs:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(lower)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            f[lang or "und"].update(tuple(w[i : i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
    for lang, c in f.items():
        some = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        inner = {p[i : i + k] for p, a in some.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if 100 * a >= covered * some[p[i : i + k]]}
        scored = []
        for p, a in some.items():
            if p not in inner:
                score, k = min((2_000_000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def found(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


@pytest.mark.parametrize(("top", "size", "ranges", "bits"), [(2000, 10_000, 3, 26), (7, 400, 50, 6)])
def test_phrases_against_brute_force(spark, monkeypatch, top, size, ranges, bits):
    """Shards that hold a few texts, more ranges than words, a filter that knows nothing any more."""
    monkeypatch.setattr(collocations.frequent, "__defaults__", (*collocations.frequent.__defaults__[:-1], bits))
    r = np.random.RandomState(top)
    words = ["a", "A", "b", "É", "日本", "x'y", " ", "the", "of", "New", "York", "\x1c"]
    p = r.dirichlet(np.ones(len(words)))
    docs = [(r.choice(["en", "de", None]), "".join(r.choice(words, p=p) + r.choice([" ", "  ", "\t", ". ", "\n", ",", "\x0b", " - "], p=[0.7, 0.05, 0.05, 0.05, 0.05, 0.04, 0.03, 0.03]) for _ in range(r.randint(0, 150)))) for _ in range(150)]
    docs += [("en", None), ("fr", ""), ("fr", "..!"), ("en", "new york city hall " * 400)]
    t = spark.createDataFrame([(i, x, lang and str(lang), 1) for i, (lang, x) in enumerate(docs)], "doc_id long, text string, lang string, phrase int").repartition(3)
    want = phrases_by_force(docs, 5, top)
    assert want and found(collocations.collocations(t, least=5, top=top, ranges=ranges, size=size)) == want


def test_phrases_of_wide_vocabularies(spark):
    """More words than pack into 64 bits by fours."""
    r = random.Random(2)
    docs = [("en", " ".join(f"w{r.randrange(200_000)}" for _ in range(3000)) + " one two three one two") for _ in range(40)]
    t = spark.createDataFrame(docs, "lang string, text string")
    assert found(collocations.collocations(t, least=20, ranges=4)) == phrases_by_force(docs, 20)
    assert collocations.collocations(t.where("false")).count() == 0


def test_automata_unite_and_compose():
    r = random.Random(4)
    lists = [Counter(" ".join(r.choice("abcdé") for _ in range(r.randint(1, 4))) for _ in range(300)) for _ in range(3)]
    automata = [collocations.Automaton.of(list(c), np.array(list(c.values()))) for c in lists]
    whole = collocations.Automaton.united([collocations.Automaton.loaded(a.dumped()) for a in automata])
    ids, f = whole.phrases()
    total = sum(lists, Counter())
    assert dict(zip(whole.spelled(ids), f.tolist())) == dict(total)
    asked = ["a", "a b", "é é é é", "z", "a z", "b z a"] + list(lists[0])[:40]
    wanted = collocations.Automaton.of(asked, np.ones(len(asked), np.int64))
    ids, f = whole.composed(wanted)
    assert dict(zip(wanted.spelled(ids), f.tolist())) == {a: total.get(a, 0) for a in asked}
