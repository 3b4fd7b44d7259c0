"""Operators that learn or approximate: held-out accuracy, recall, and what they must leave alone; and odd rows."""

import math
import re
from contextlib import nullcontext
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cellstream import scratch
from cellstream.llm import ann_graph, langid, line_templates, mixing, weak_quality
from cellstream.llm.queries import ORACLE_SQL, QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string"
ODD = [(None, "null id here, with some words.", "en", "a", 1, "x"), (1, None, "en", "a", None, "x"), (2, "", None, "a", 0, "x"), (3, " \t\n ", "en", None, 4, "x"), (4, "12345 678", "en", "a", 1, "x"), (5, "word " * 30_000, "de", "a", 1, "x"), (5, "word " * 30_000, "de", "a", 1, "x")]
SYLLABLES = {"en": ["the", "and", "ing", "tion", "wh", "ea"], "de": ["sch", "ein", "ung", "ich", "öß", "und"], "fr": ["eau", "ique", "ère", "ent", "ç", "oi"]}


def prose(r, lang, n):
    words = ["".join(r.choice(SYLLABLES[lang], r.randint(1, 4))) for _ in range(n)]
    return " ".join(w + "." if i % 9 == 8 else w for i, w in enumerate(words)) + "."


def corpus(spark, n=120, seed=8):
    r = np.random.RandomState(seed)
    langs = r.choice(list(SYLLABLES), n, p=[0.6, 0.3, 0.1])
    return spark.createDataFrame([(i, prose(r, k, r.randint(5, 80)), str(k), "s", None, "x") for i, k in enumerate(langs)], DOCS)


def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_languages_held_out(spark):
    docs = corpus(spark)
    got = langid.languages(docs, F.col("doc_id") % 4 != 2).join(docs.select("doc_id", "lang"), "doc_id").where("doc_id % 4 = 2").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.95 and all(0 <= r["score"] <= 1 for r in got)


def test_language_of_mixed_text(spark):
    r = np.random.RandomState(9)
    both = spark.createDataFrame([(900, prose(r, "en", 120) + " " + prose(r, "fr", 60), None, "s", 1, "x")], DOCS)
    got = langid.languages(corpus(spark).unionByName(both), F.col("doc_id") < 900).where("doc_id = 900").first()
    assert got["lang_pred"] == "en" and set(got["proportions"]) == {"en", "fr"} and 0.5 < got["score"] < 0.85


def test_a_text_may_have_more_than_three_languages():
    rng = np.random.RandomState(5)
    table = rng.dirichlet(np.full(400, 0.05), 6).T.astype(np.float32) + np.float32(1e-6)
    for k in (1, 2, 4, 5):
        n = np.round(4000 * table[:, :k].mean(1)).astype(int)
        at = np.flatnonzero(n)
        _, score, w = langid.infer((at, n[at]), table, penalty=4.0, rounds=12)
        assert np.flatnonzero(w).tolist() == list(range(k)) and abs(score - 1 / k) < 0.1


def test_languages_of_odd_rows(spark):
    got = langid.languages(corpus(spark).unionByName(odd(spark)), F.lit(True)).where("doc_id is null or doc_id < 6").collect()
    assert len([r for r in got if r["doc_id"] is None]) == 1
    untaught = langid.languages(odd(spark), F.lit(False)).collect()
    assert len(untaught) == len(ODD) and {(r["lang_pred"], r["score"]) for r in untaught} == {("und", 0.0)}
    letterless = langid.languages(odd(spark), F.lit(True)).where("doc_id between 1 and 4").collect()
    assert {r["lang_pred"] for r in letterless} == {"und"}
    assert langid.languages(empty(spark), F.lit(True)).count() == 0


def spoiled(r, text, how):
    words = text.split()
    if how == 0:
        return " ".join(w + r.choice(["###", "$$$"]) for w in words)
    return " | ".join(words) if how == 1 else " ".join(w for w in words[:8] for _ in range(9))


def test_quality_without_labelled_rows(spark):
    r = np.random.RandomState(10)
    good = [(i, prose(r, "en", r.randint(10, 200)), "en", "s", None, "x") for i in range(300)]
    bad = [(1000 + i, spoiled(r, prose(r, "en", r.randint(20, 200)), i % 3), "en", "s", None, "x") for i in range(60)]
    got = weak_quality.quality(spark.createDataFrame(good + bad, DOCS)).collect()
    assert np.mean([x["kept"] for x in got if x["doc_id"] < 1000]) > 0.98
    assert np.mean([not x["kept"] for x in got if x["doc_id"] >= 1000]) > 0.95


def test_toxic_texts_are_rejected_whatever_their_form(spark):
    r = np.random.RandomState(18)
    insults = ("idiot", "clown", "worthless", "Trottel", "estúpido", "дурак")
    labelled = [(f"{prose(r, 'en', 40)} You {w}, {w.upper()}! {prose(r, 'de', 20)}", 1) for w in insults for _ in range(6)] + [(prose(r, "en", 80), 0) for _ in range(100)]
    texts = [prose(r, "en", 100) for _ in range(200)]
    texts += [f"{prose(r, 'en', 40)} You {w}, {w.upper()}! {prose(r, 'de', 40)}" for w in insults]
    harmless = ["A word alone, worthless, is quoted. " + prose(r, "en", 100), "The clown performed at the circus and children laughed all the evening long.", "He read a novel by Dostoevsky, The Idiot, in one long night in the garden.", "Two clown acts and an idiot of a horse. " + prose(r, "en", 2000)]
    t = spark.createDataFrame([(i, x, "en", "s", None, "x") for i, x in enumerate(texts + harmless)], DOCS)
    got = {x["doc_id"]: x for x in weak_quality.quality(t, toxic=spark.createDataFrame(labelled, "text string, toxic int")).collect()}
    assert all(not got[i]["kept"] and got[i]["votes"][-1] == "-" for i in range(200, 200 + len(insults))) and all(got[i]["kept"] for i in range(200 + len(insults), len(got)))
    assert np.mean([got[i]["kept"] for i in range(200)]) > 0.98
    assert all(x["votes"][-1] != "-" for x in weak_quality.quality(t).collect())  # nothing was learned


def votes_by_force(text, toxic):
    words = re.findall(r"[^\x20\x09-\x0d]+", text)
    n = len(words)
    letters = [sum(map(str.isalpha, w)) for w in words]
    marks = [any(not c.isalnum() and c not in ".,;:!?'\"()-" for c in w) for w in words]
    again = sum(a == b for a, b in zip(words, words[1:]))
    triples = len(set(zip(words, words[1:], words[2:])))
    stops = sum(w[-1] in ".!?:;" for w in words)
    insults = sum(w in toxic for w in re.findall(r"\w+", text.lower()))
    rules = [
        (1, sum(marks) > 0.2 * n), (1, sum(x > 0 and not y for x, y in zip(letters, marks)) < 0.7 * n), (5, sum(not x for x in letters) > 0.15 * n),
        (1, sum(letters) < 0.72 * sum(map(len, words))), (5, again > 0.15 * n), (12, triples < 0.6 * (n - 2)), (30, not stops or stops > 0.5 * n),
        (12, not 2 * n <= sum(letters) <= 12 * n), (1, insults >= max(2, 0.005 * n)),
    ]
    return "".join("?" if n < least else "-" if bad else "+" for least, bad in rules)


def shapes_by_force(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", text)
    return sorted(Counter(re.sub("[a-z\x80-\U0010ffff]+", "a", re.sub("[0-9]+", "9", re.sub("[A-Z]+", "A", w))) for w in words).values())


def test_measures_against_brute_force():
    r = np.random.RandomState(19)
    parts = ["the", "The", "a-b", "...", "don't", "x1y22", "###", "é", "日本語", "idiot", "Idiot!", "1234", "stem", "stemming", "stemmed.", "🎉", "\u00a0", "q_r", "ABCdef9", "|"]
    texts = ["", None, "  \n"] + [" ".join(r.choice(parts, r.randint(1, 60))).replace("| ", "\n\t") for _ in range(400)] + ["one " * 3000, " lead"]
    lexicon = weak_quality.Lexicon(frozenset(["idiot$", "stemm", "q_r$"]))
    for at in range(0, len(texts), 37):
        group = texts[at : at + 37]
        votes, owner, index, weight = weak_quality.measured(group, 20, lexicon)
        assert weak_quality._names(votes) == [votes_by_force(t or "", {"idiot", "stemming", "stemmed", "q_r"}) for t in group]
        for i, t in enumerate(group):
            own = (owner == i) & (index < 1 << 20)
            n = len((t or "").encode().split())
            assert np.allclose(sorted(weight[own] ** 2 * n), shapes_by_force(t or ""))


def test_words_of_toxic_texts_are_learned(spark):
    r = np.random.RandomState(20)
    rows = [(i, prose(r, "de", 60) + (f" bozzel{'nmrst'[i % 5]} mistig." if i % 7 == 0 else ""), int(i % 7 == 0)) for i in range(400)]
    labelled = spark.createDataFrame([x[1:] for x in rows[:200]] + [(None, 1), ("text", None)], "text string, toxic int")
    assert {"bozzel", "mistig$"} <= weak_quality.toxic_terms(labelled) and not weak_quality.toxic_terms(labelled.where("toxic = 0"))
    got = {x["doc_id"]: x["kept"] for x in weak_quality.quality(spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string"), toxic=labelled).collect()}
    assert all(got[i] != bool(x) for i, _, x in rows)


def test_labellers_accuracies_are_found():
    r = np.random.RandomState(11)
    truth = r.rand(4000) < 0.7
    rate = np.array([[0.6, 0.5, 0.4, 0.7], [0.02, 0.05, 0.01, 0.1]])
    votes = np.where(r.rand(4000, 4) < rate[(truth).astype(int)], 0, 1)
    votes[r.rand(4000, 4) < 0.1] = -1
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    share, says_bad = weak_quality.accuracies(patterns, counts.astype(float))
    assert abs(share - 0.7) < 0.1 and np.abs(says_bad - rate).max() < 0.15


def test_quality_of_odd_rows(spark):
    got = weak_quality.quality(odd(spark))
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "votes", "posterior", "score", "kept"]
    found = got.collect()
    assert len(found) == len(ODD) and all(not r["kept"] and r["score"] == 0 for r in found if r["doc_id"] in (1, 2, 3))
    assert weak_quality.quality(empty(spark)).count() == 0


def test_recurring_lines_go_and_copies_stay(spark):
    r = np.random.RandomState(12)
    docs = []
    for i in range(40):
        lines = [prose(r, "en", 9) for _ in range(4)]
        if i % 2:
            lines.insert(2, f"Page {i} of the site was last changed on day {i * 7}")
        if i % 3 == 0:
            lines.append(f"Login of user {'abcdefghijklmnopqrstuvwxyz'[i % 26]}name from the main office")
        docs.append((i, "\n".join(lines), "en", "s", None, "x"))
    copy = "\n".join(prose(r, "de", 12) for _ in range(5))
    docs += [(100 + i, copy, "de", "s", None, "x") for i in range(30)]
    got = {x["doc_id"]: x for x in line_templates.without_recurring_lines(spark.createDataFrame(docs, DOCS)).collect()}
    for i, text, *_ in docs:
        lines = text.split("\n")
        want = [x for x in lines if not x.startswith(("Page ", "Login "))]
        assert got[i]["text"].split("\n") == want and got[i]["n_dropped"] == len(lines) - len(want) and got[i]["n_lines"] == len(lines)


def test_long_recurring_lines_go(spark):
    # Passages that are most of their documents: the least hash of the whole is the passage's own.
    r = np.random.RandomState(15)
    passages = [prose(r, "en", 60) for _ in range(12)]
    docs = [(100 * k + i, f"{prose(r, 'de', 20)}\n{p}", "en", "s", None, "x") for k, p in enumerate(passages) for i in range(30)]
    got = {x["doc_id"]: x["text"] for x in line_templates.without_recurring_lines(spark.createDataFrame(docs, DOCS)).collect()}
    assert all(got[i] == text.split("\n")[0] for i, text, *_ in docs)


def test_copies_take_nothing_from_other_recurrences(spark):
    r = np.random.RandomState(16)
    common = prose(r, "en", 12)
    docs = [(i, f"{prose(r, 'de', 40)}\n{common}", "en", "s", None, "x") for i in range(40)]
    one = prose(r, "de", 100).split()
    near = [" ".join(prose(r, "en", 1) if r.rand() < 0.03 else w for w in one) for _ in range(150)]
    docs += [(100 + i, f"{text}\n{common}", "en", "s", None, "x") for i, text in enumerate([" ".join(one)] * 150 + near)]
    got = {x["doc_id"]: x["text"] for x in line_templates.without_recurring_lines(spark.createDataFrame(docs, DOCS)).collect()}
    assert all(got[i] == text.split("\n")[0] for i, text, *_ in docs)
    alone = {x["doc_id"]: x["text"] for x in line_templates.without_recurring_lines(spark.createDataFrame(docs[40:], DOCS)).collect()}
    assert all(alone[i] == text for i, text, *_ in docs[40:])


def test_texts_are_shuffled_unsorted_and_without_what_came_before(spark, monkeypatch):
    """By the same plan at any size, with the parsed lines deleted; and ends of lines are counted in bytes."""
    plain, left = line_templates._crowded, []

    def crowded(docs, picked, *rest):
        left.extend(p for p in made if "llm-lines" in p and scratch.exists(spark, p))
        return plain(docs, picked, *rest)

    monkeypatch.setattr(line_templates, "_crowded", crowded)
    docs = [(i, f"own {i}\nthe same line in every one\nlast {i} é", "en", "s", None, "x") for i in range(20)]
    with scratch.recorded() as made:
        found = line_templates.without_recurring_lines(spark.createDataFrame(docs, DOCS))
    assert left == [] and [p.split("llm-")[1].split("-")[0] for p in made if scratch.exists(spark, p)] == ["gone"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan and "translate" not in plan
    assert all(r["n_lines"] == 3 for r in found.collect())


@pytest.mark.parametrize("words, times", [(60, 2), (35, 5)])
def test_the_longer_a_line_the_fewer_recurrences_it_takes(spark, words, times):
    r = np.random.RandomState(17)
    passages, short = ([prose(r, lang, n) for _ in range(6)] for lang, n in (("en", words), ("fr", 12)))
    docs = [(100 * k + i, f"{prose(r, 'de', 30)}\n{passages[k]}\n{short[(k + i) % 6]}", "en", "s", None, "x") for k in range(6) for i in range(times)]
    rare = [prose(r, "en", 60) for _ in range(4)]
    docs += [(1000 + i, text, "en", "s", None, "x") for i, text in enumerate("\n".join([*rare, prose(r, "de", 9)]) for _ in range(5))]  # near copies
    got = {x["doc_id"]: x["text"].split("\n") for x in line_templates.without_recurring_lines(spark.createDataFrame(docs, DOCS)).collect()}
    assert all(got[i] == text.split("\n")[:: 2 if i < 1000 else 1] for i, text, *_ in docs)


def mix(x):
    x %= 2**64
    x ^= x >> 31
    x = x * 0x9E3779B97F4A7C15 % 2**64
    x ^= x >> 29
    x = x * 0xD6E8FEB86659FD93 % 2**64
    return x ^ x >> 32


def series(values):
    return sum(v * pow(0x9E3779B97F4A7C15, i, 2**64) for i, v in enumerate(values)) % 2**64


def without_recurring_by_force(texts, depth=3, min_docs=8, min_tokens=3, constant=0.6):
    """Texts by their keys, all in dictionaries and loops; only the sketches use the operator's hash, as they depend on it."""
    lines, sketches = {}, {}
    for key, text in texts.items():
        by_line = []
        for k, line in enumerate((text or "").split("\n")):
            words = re.findall(r"[^\x20\x09-\x0d]+", line)
            if words:
                tokens = tuple("<*>" if re.search("[0-9]", w) else w for w in words)
                h = [mix(series(map(ord, w))) for w in words]
                triples = [mix(mix(mix(x + 1) + y) + z) for x, y, z in zip(h, h[1:], h[2:])] or [mix((3 + series(h)) % 2**64)]
                by_line.append((k, tokens, (len(tokens), tokens[:depth]), triples))
        for k, tokens, leaf, _ in by_line:
            if len(tokens) >= min_tokens:
                lines[key, k] = leaf, tokens
                sketches[key, k] = tuple(sorted({x for *_, other, triples in by_line if other != leaf for x in triples})[:8])
    need = lambda n: min(min_docs, math.ceil(min_docs - (min_docs - 2) * min(1, max(0, (n - 20) / 30))))
    docs_of, support = {}, {}
    for (key, _), (leaf, _) in lines.items():
        docs_of.setdefault(leaf, set()).add(texts[key])
    lines = {at: x for at, x in lines.items() if len(docs_of[x[0]]) >= need(x[0][0])}
    for at, (leaf, tokens) in lines.items():
        for i in range(depth, len(tokens)):
            support.setdefault((leaf, i, tokens[i]), set()).add(sketches[at][0] if sketches[at] else leaf)
    of_template = {}
    for at, (leaf, tokens) in lines.items():
        kept = tuple((i, w) for i, w in enumerate(tokens) if i >= depth and len(support[leaf, i, w]) >= need(len(tokens)))
        if len(kept) + sum(w != "<*>" for w in tokens[:depth]) >= constant * len(tokens):
            of_template.setdefault((leaf, kept), []).append(at)
    dropped = {}
    for (leaf, _), members in of_template.items():
        own = {sketches[at] for at in members}
        company = Counter(v for s in own for v in s or (0,))
        different = sum(1 / sorted((company[v] for v in s or (0,)), reverse=True)[min(3, len(s or (0,))) - 1] for s in own)
        if different > need(leaf[0]) - 0.5:
            for key, k in members:
                dropped.setdefault(key, set()).add(k)
    left = {key: "\n".join(line for k, line in enumerate((text or "").split("\n")) if k not in dropped.get(key, ())) for key, text in texts.items()}
    return {key: (texts[key], 0) if not left[key].strip() else (left[key] if texts[key] is not None else None, len(dropped.get(key, ()))) for key in texts}


@pytest.mark.parametrize("seed", [1, 2])
def test_lines_against_brute_force(spark, seed):
    r = np.random.RandomState(seed)
    frames = [[str(r.choice(["open", "shut", "read", "from", "user", "site", "of"])) if r.rand() < 0.7 else None for _ in range(r.choice([3, 5, 9, 24, 55]))] for _ in range(12)]
    texts = {}
    for i in range(160):
        lines = []
        for _ in range(r.randint(1, 7)):
            frame = frames[r.randint(len(frames))] if r.rand() < 0.6 else [None] * r.randint(0, 9)
            lines.append("\t ".join(w or str(r.choice(["a", "b", "n1", "77", "x", f"w{i}", f"q{'abcdefgh'[i % 8]}"])) for w in frame))
        texts[i] = "\n".join(lines)
    for i in range(160, 200):  # copies, and near copies
        texts[i] = texts[i % 7] if i % 2 else texts[i % 7] + f"\nown {'xyz'[i % 3]}"
    texts |= {300: "", 301: None, 302: "\n \n", 303: "of of of\n" * 4000, 304: " \u00a0 é"}
    rows = [(i, t, "en", "s", None, "x") for i, t in texts.items()] + [(3, texts[3], "en", "s", None, "x")]
    got = line_templates.without_recurring_lines(spark.createDataFrame(rows, DOCS)).collect()
    want = without_recurring_by_force(texts)
    assert sum(n for _, n in want.values()) > 30
    assert len(got) == len(rows) and {x["doc_id"]: (x["text"], x["n_dropped"]) for x in got} == want
    assert all(x["n_lines"] == (0 if texts[x["doc_id"]] is None else texts[x["doc_id"]].count("\n") + 1) for x in got)


def test_lines_of_odd_rows(spark):
    clash = odd(spark).withColumns({c: F.concat(F.lit(c), F.col("n_chars").cast("string")) for c in ("n_lines", "key", "gone", "rest", "__key")})
    got = line_templates.without_recurring_lines(clash)
    assert sorted(map(str, [(r["doc_id"], r["text"], r["n_dropped"]) for r in got.collect()])) == sorted(map(str, [(i, t, 0) for i, t, *_ in ODD]))
    assert dict(got.dtypes)["n_lines"] == "bigint" and got.where("key <> concat('key', n_chars) or __key <> concat('__key', n_chars)").count() == 0
    assert line_templates.without_recurring_lines(empty(spark)).count() == 0
    same = spark.createDataFrame([(i, "the same only line here", "en", "s", 1, "x") for i in range(30)], DOCS)
    assert {r["text"] for r in line_templates.without_recurring_lines(same).collect()} == {"the same only line here"}


@pytest.mark.parametrize("least", [0.0, 1.0])
def test_mixing_meets_its_targets(spark, least):
    docs = corpus(spark, 200)
    labelled = docs.where("doc_id % 3 = 0").select("text", F.col("lang").alias("domain"))
    weights = {"en": 0.4, "de": 0.3, "fr": 0.3}
    got = mixing.mixed(docs, labelled, weights, least).collect()
    assert np.mean([r["domain"] == r["lang"] for r in got]) > 0.95 and min(r["rate"] for r in got) >= least
    mass = sum(np.array(r["p"]) * r["rate"] * r["tokens"] for r in got)
    assert np.allclose(mass / mass.sum(), [0.3, 0.4, 0.3], atol=0.01)
    assert all(abs(r["copies"] - r["rate"]) < 1 for r in got)


def test_mixing_of_odd_rows(spark):
    labelled = corpus(spark).select("text", F.col("lang").alias("domain"))
    assert mixing.mixed(odd(spark), labelled, {"en": 1.0}).count() == len(ODD)
    assert {r["rate"] for r in mixing.mixed(odd(spark), labelled.where("false"), {"en": 1.0}).collect()} == {1.0}
    assert mixing.mixed(empty(spark), labelled, {"en": 1.0}).count() == 0


def test_domains_of_any_script_are_learned(spark):
    r = np.random.RandomState(21)
    words = {"ru": "и в не на что он как это по но из мы так же вот только ещё человек время".split(), "ja": "これは それは 本です 私の 学校に 行きました 東京で 食べる 見ました とても".split(), "el": "και το να είναι με που για από αυτό ότι".split()}
    text = lambda d: ("" if d == "ja" else " ").join(r.choice(words[d], 30))
    labelled = spark.createDataFrame([(text(d), d) for d in words for _ in range(20)], "text string, domain string")
    docs = spark.createDataFrame([(i, text(d), d) for i, d in enumerate(list(words) * 40)], "doc_id long, text string, f0 string")
    got, domains = mixing.posteriors(docs, labelled)
    assert domains == ["el", "ja", "ru"] and set(got.columns) == {"doc_id", "text", "f0", "tokens", "p"}
    assert np.mean([domains[int(np.argmax(x["p"]))] == x["f0"] for x in got.collect()]) > 0.95


@pytest.mark.parametrize("number", [1, 40, 200])
def test_every_domain_has_its_features(spark, number):
    """Domains of words of their own, of all letters; one domain alone is no obstacle."""
    r = np.random.RandomState(23)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    words = [["".join(r.choice(letters, r.randint(3, 7))) for _ in range(12)] for _ in range(number)]
    text = lambda d: " ".join(r.choice(words[d], 25))
    labelled = spark.createDataFrame([(text(d), f"d{d:03d}") for d in range(number) for _ in range(6)], "text string, domain string")
    docs = spark.createDataFrame([(i, text(i % number), i % number) for i in range(3 * number)], "doc_id long, text string, d int")
    got, domains = mixing.posteriors(docs, labelled)
    assert domains == sorted(f"d{d:03d}" for d in range(number))
    assert np.mean([int(np.argmax(x["p"])) == x["d"] for x in got.select("p", "d").collect()]) > 0.95


def test_domains_of_common_strings_only(spark):
    labelled = spark.createDataFrame([("aa ab aa", "x"), ("bb ba bb", "y")] * 5, "text string, domain string")
    got, _ = mixing.posteriors(spark.createDataFrame([(0, "aa aa aa"), (1, "bb bb")], "doc_id long, text string"), labelled)
    assert [int(np.argmax(x["p"])) for x in got.orderBy("doc_id").collect()] == [0, 1]


def test_posteriors_against_brute_force(spark):
    docs = corpus(spark, 60)
    labelled = docs.where("doc_id % 2 = 0").select("text", F.col("lang").alias("domain"))
    got, domains = mixing.posteriors(docs, labelled)
    features = mixing.learned_features(labelled)
    train = [(x["text"].lower(), x["domain"]) for x in labelled.collect()]
    n = np.array([[0.5 + sum(t.count(f) for t, d in train if d == own) for f in features] for own in domains])
    share = np.log(n / n.sum(1, keepdims=True))
    prior = np.log([sum(d == own for _, d in train) / len(train) for own in domains])
    for x in got.collect():
        k = np.array([x["text"].lower().count(f) for f in features])
        ll = prior + 100 / max(100, k.sum()) * (share @ k)
        assert np.allclose(x["p"], np.exp(ll - ll.max()) / np.exp(ll - ll.max()).sum(), atol=1e-9)


@pytest.mark.parametrize(("least", "targets"), [(0.0, [900.0, 300.0, 600.0]), (0.0, [900.0, 0.0, 600.0]), (1.0, [2000.0, 5.0, 900.0])])
def test_rates_against_brute_force(spark, least, targets):
    r = np.random.RandomState(22)
    t, p = r.randint(1, 40, 60), r.dirichlet([0.4] * 3, 60)
    members = spark.createDataFrame([(int(n), x.tolist()) for n, x in zip(t, p)], "tokens long, p array<double>")
    mass = p * t[:, None]
    rate = np.maximum(np.ones(60), least)
    for _ in range(100_000):  # plain projected gradient
        rate = np.maximum(least, rate + 0.9 / np.linalg.norm(mass, 2) ** 2 * (mass @ (targets - mass.T @ rate)))
    unmet = np.max(np.abs(targets - mass.T @ rate) / np.maximum(targets, 1.0)) > 0.02
    with pytest.warns(UserWarning, match="residual") if unmet else nullcontext():
        steps = mixing.fit_rates(members, targets, least, rounds=12)
    got = np.array([x[0] for x in mixing.rated(members, steps, least).select("rate").collect()])
    cost = lambda x: float(((targets - mass.T @ x) ** 2).sum())
    assert got.min() >= least and cost(got) ** 0.5 <= 1.02 * cost(rate) ** 0.5 + 0.02 * sum(targets)


def test_neighbours_recall_and_ties(spark):
    r = np.random.RandomState(13)
    x = r.standard_normal((1500, 24)).astype(np.float32)
    x[1400:] = x[7]  # copies
    t = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {}
    for row in ann_graph.nearest(t, t.where("vec_id % 50 = 0 or vec_id = 7"), shard=500).collect():
        got.setdefault(row["query_id"], []).append((row["rank"], row["score"], row["vec_id"]))
    hits = []
    for q, found in got.items():
        far = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(1))
        want = sorted((d, i) for i, d in enumerate(far) if i != q)[:10]
        found = sorted(found)
        assert [k for k, *_ in found] == list(range(1, 11)) and [(s, i) for _, s, i in found] == sorted((s, i) for _, s, i in found)
        assert all(abs(s - far[i]) < 1e-12 for _, s, i in found)
        hits.append(len({i for _, i in want} & {i for *_, i in found}))
    assert np.mean(hits) >= 9 and [i for *_, i in sorted(got[7])] == list(range(1400, 1410))


def test_neighbours_of_double_vectors(spark):
    """Distances far below what floats can hold."""
    t = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0 + 2e-9, 2.0]), (2, [1.0 + 1e-9, 2.0]), (3, [1.0, 3.0])], "vec_id long, embedding array<double>")
    got = ann_graph.nearest(t, t.where("vec_id = 0"), k=3).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [2, 1, 3] and np.allclose([r["score"] for r in got], [1e-9, 2e-9, 1.0], rtol=1e-6, atol=0)


def test_neighbours_of_odd_rows(spark):
    bad = [(1, None), (2, [0.0, 0.0]), (3, [float("nan"), 1.0]), (4, [None, 1.0]), (None, [1.0, 1.0]), (5, [1.0, 2.0]), (6, [1.0, 2.5]), (7, [1.0, 2.0, 3.0]), (8, [1.0, 2.5])]
    t = spark.createDataFrame(bad, "vec_id long, embedding array<float>")
    assert [tuple(r) for r in ann_graph.nearest(t, t).orderBy("query_id", "rank").collect()] == [(5, 1, 6, 0.5), (5, 2, 8, 0.5), (6, 1, 8, 0.0), (6, 2, 5, 0.5), (8, 1, 6, 0.0), (8, 2, 5, 0.5)]
    assert ann_graph.nearest(t.where("false"), t.where("false")).count() == 0


def test_stages_of_the_pipeline(spark, tmp_path):
    r = np.random.RandomState(14)
    docs = corpus(spark, 150).collect()
    rows = [tuple(d) for d in docs]
    rows += [(500 + i, docs[i]["text"], docs[i]["lang"], "s", 1, "x") for i in range(20) if len(docs[i]["text"].split()) > 8]  # copies
    rows += [(700 + i, spoiled(r, prose(r, "en", 60), i % 3), "en", "s", 1, "x") for i in range(30)]
    spark.createDataFrame(rows + ODD, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(0, 150, 2)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.stored(stage(spark, docs, str(tmp_path)), name)
        assert after.columns == docs.columns
        seen[name], docs = [x["doc_id"] for x in after.collect()], after
    clean = set(range(150))
    kept = clean & set(seen["quality"])
    assert len(kept) >= 147 and sum(i >= 700 for i in seen["quality"] if i is not None) <= 2
    assert sorted(seen["line_dedup"], key=str) == sorted(seen["quality"], key=str)
    assert kept <= set(seen["near_dedup"]) and not any(i is not None and 500 <= i < 700 for i in seen["near_dedup"])
    assert set(seen["mix"]) == set(seen["near_dedup"]) and len(seen["mix"]) > len(seen["near_dedup"])
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert {x["doc_id"] for x in pieces.collect()} == set(seen["mix"])


def test_stages_leave_clashing_columns_alone(spark, tmp_path):
    more = ("votes", "score", "kept", "tokens", "rate", "p", "n_lines", "copies", "component_id", "low", "e", "f1")
    docs = corpus(spark, 40).drop("score").withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in more})
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, str(tmp_path))
        assert after.columns == docs.columns
        assert after.where(" or ".join(f"{c} <> concat('{c}', doc_id)" for c in more)).count() == 0
    assert mixing.mixed(docs, docs.select("text", F.col("lang").alias("domain")), {"en": 1.0}).select("low", "e", "f1").where("low <> concat('low', doc_id)").count() == 0


def test_every_operator_has_its_query():
    assert {int(q[2:].split("_")[0]) for q in QUERIES} == set(range(1, 14)) and set(ORACLE_SQL) <= set(QUERIES)
