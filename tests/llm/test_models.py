"""Language identification, toxicity, quality, scoring and quality rules: plain recounts and held-out accuracy."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from standbyspark.llm import language_id, quality_gam, quality_rules, suffix_lm, toxicity
from standbyspark.llm import textkit as tk

WORD = re.compile(r"[^\x20\x09-\x0d]+")
SF = "/root/testdata/sf0.01"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


TEXTS = ["", None, " ", "a", "A b\tc\x0bd\r\ne ", "é ü\u2028x\u00a0y", "word " * 700, "x" * 3000 + " y", "a a a a a\nb b\nb b\n \nb b", "# * | <<>> end!", "\n\nq w e q w e"]


def test_words_and_hashes_equal_the_pattern(monkeypatch):
    monkeypatch.setattr(tk, "SEGMENT", 97)
    w = tk.words(pa.array(TEXTS))
    plain = [WORD.findall(t or "") for t in TEXTS]
    assert w.counts.tolist() == [len(p) for p in plain]
    text = w.data.tobytes()
    assert [text[a:b].decode() for a, b in zip(w.starts, w.ends, strict=True)] == [x for p in plain for x in p]
    flat, h = [x for p in plain for x in p], w.hashes()
    assert len({*h.tolist()}) == len({lower(x) for x in flat}) and len({*w.hashes(fold=False).tolist()}) == len({*flat})
    sliced = tk.words(pa.array(["zz", *TEXTS]).slice(1))
    assert (sliced.hashes() == h).all() and tk.words(pa.array([], pa.string())).counts.tolist() == []


def rule_counts(text):
    text = text or ""
    w = WORD.findall(text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = {g for g, n in Counter(grams).items() if n > 1}
    covered = {i + k for i, g in enumerate(grams) if g in often for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_rule_counts_equal_plain_ones():
    rng = random.Random(1)
    texts = TEXTS + [" ".join(rng.choice(["a", "b", "c\n", "D#", "é"]) for _ in range(rng.randrange(90))) for _ in range(60)]
    got = quality_rules.counts_of(pa.array(texts))
    assert list(zip(*(got[c].tolist() for c in quality_rules.COUNTS), strict=True)) == [rule_counts(t) for t in texts]


def test_order_of_rules_changes_no_verdict(spark):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    names = [r.name for r in quality_rules.RULES]
    verdicts = {tuple(quality_rules.judge(pa.array(texts), order)["kept"].tolist()) for order in (names, names[::-1], [x[0] for x in quality_rules.measured_order(texts[:200])])}
    assert len(verdicts) == 1
    ordered = quality_rules.measured_order(texts)
    assert [x[0] for x in ordered][0] in {n for n, _, share in ordered if share > 0}


def test_rules_keep_good_and_reject_bad(spark):
    out = quality_rules.apply(spark.read.parquet(f"{SF}/documents.parquet")).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").filter("n_words >= 50").groupBy("quality", "kept").count().collect()
    n = {(r["quality"], r["kept"]): r["count"] for r in out}
    assert n.get((1, False), 0) <= 0.02 * n[1, True] and n.get((0, True), 0) <= 0.1 * n[0, False]


def test_suffix_automaton_reads_all_substrings_only():
    rng = random.Random(7)
    text = bytes(rng.randrange(1, 4) for _ in range(60))
    following, _ = language_id.suffix_automaton(text)
    inside = {text[i:j] for i in range(60) for j in range(i, 61)}
    for _ in range(2000):
        word = bytes(rng.randrange(1, 4) for _ in range(rng.randrange(7)))
        state = 0
        for c in word:
            state = following[state].get(c) if state is not None else None
        assert (state is not None) == (word in inside)


def test_phrase_counts_equal_greedy_parsing(monkeypatch):
    monkeypatch.setattr(language_id, "BLOCK", 11)
    rng = random.Random(8)
    samples = tuple((n, bytes(rng.choice(a) for _ in range(80))) for n, a in (("x", [1, 2, 3]), ("y", [2, 3, 4, 5])))
    texts = [bytes(rng.randrange(1, 7) for _ in range(rng.randrange(40))) for _ in range(50)] + [samples[0][1][5:75], samples[1][1] * 3]

    def greedy(text, sample):
        n = 0
        while text:
            k = next((k for k in range(len(text), 0, -1) if text[:k] in sample), 1)
            n, text = n + 1, text[k:]
        return n

    table, starts, _ = language_id.parser(samples)
    got = language_id.phrases(np.frombuffer(b"".join(texts), dtype=np.uint8), np.cumsum([0, *map(len, texts)]), table, starts)
    assert got.tolist() == [[greedy(t, s) for _, s in samples] for t in texts]


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language_id.identified(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.min("score"), F.max("score")).collect()[0]
    assert got[0] > 0.97 and 0 <= got[1] <= got[2] <= 1


def test_every_language_is_learned(make, monkeypatch):
    letters = "abcdefghijklmnopqrstuvwxyz"
    names = [a + b for a in "abcdefghi" for b in letters[:8]]  # 72 languages, each of three letters of its own
    alphabet = {n: [chr(0x400 + 3 * i + k) for k in range(3)] for i, n in enumerate(names)}
    rng = random.Random(3)
    rows = [(10 * i + k, " ".join("".join(rng.choice(alphabet[n]) for _ in range(5)) for _ in range(20)), n) for i, n in enumerate(names) for k in range(10)]
    docs = make(rows)
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.identified(docs).collect()}
    known = {n for d, _, n in rows if zlib.crc32(str(d).encode()) % 3 != 1}
    assert len(known) == 72 and sum(got[d] == n for d, _, n in rows) >= 0.95 * len(rows)  # some share bytes
    monkeypatch.setattr(language_id, "ALL_SYMBOLS", 72 * 100)
    assert all(len(s) <= 100 for _, s in language_id.samples_of(docs)) and len(language_id.samples_of(docs)) == 72


def test_predictions_equal_plain_greedy_parsing(make):
    rng = random.Random(4)
    words = {"xx": ["bana", "nana", "ban", "na"], "yy": ["nab", "anna", "bab", "a"]}
    rows = [(i, " ".join(rng.choice(words[n]) for _ in range(rng.randrange(1, 300))), n) for i in range(60) for n in [rng.choice(["xx", "yy"])]]
    docs = make([*rows, (900, "b", None), (901, "123", None), (902, None, None)])
    samples = language_id.samples_of(docs.filter(~(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1)))
    code = lambda text: bytes(0 if not c.isalpha() else ord(c) - 96 for c in text)

    def cost(text, sample):
        text, n = code(text), 0
        while text:
            k = next((k for k in range(min(len(text), 80), 0, -1) if text[:k] in sample), 1)
            n, text = n + 1, text[k:]
        return n * math.log2(max(len(sample), 2))

    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identified(docs).collect()}
    assert got[901] == got[902] == ("und", 0.0)
    for d, text, _ in rows:
        costs = [cost(text, s) for _, s in samples]
        best = min(range(len(samples)), key=lambda i: costs[i])  # ties go to the first name
        assert got[d][0] == samples[best][0]
        assert math.isclose(got[d][1], 1 / sum(2 ** -min((c - costs[best]) / 8, 1000) for c in costs), rel_tol=1e-9)


def test_language_edges(odd):
    got = {(r["doc_id"], r["lang_pred"]) for r in language_id.identified(odd).collect()}
    assert {(None, "und"), (1, "und"), (2, "und"), (3, "und")} <= got and all(x != "und" for d, x in got if d in (4, 5, -6, 7))
    assert {r["lang_pred"] for r in language_id.identified(odd.withColumn("lang", F.lit(None))).collect()} == {"und"}
    assert language_id.identified(odd.limit(0)).count() == 0


@pytest.fixture(scope="module")
def toxic_model(spark):
    return toxicity.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))


@pytest.mark.parametrize("word", ["1d10t", "m0r0n", "s.c.u.m", "$tup1d", "idiiiiot", "tr@sh", "l o s e r", "m o r o n", "scuuuum", "MOR0N!", "'idiot'", "stuupid", "iidiot", "id iot", "idioot", "mooron", "youidiot", "you...idiot", "a m o r o n", "y o u i d i o t", "$ c u m", "st upid", "i-d-i-o-t", "i" * 300 + "diot", "x" * 60 + " t.r.a.s.h"])
def test_disguises_are_undone(toxic_model, word):
    s = toxicity.Scorer(toxic_model)
    assert s.score(f"the of {word} and") >= toxicity.THRESHOLD > s.score("the of nothing and")


def test_clean_neighbours_are_left_alone(toxic_model):
    s = toxicity.Scorer(toxic_model)
    for text in ("closer", "enclosers", "trashier", "lo sere", "clo when", "tr as he", "an id in ot her", "2024 10 07 5 6 7 8", "a b c d e f g h i j", "", None):
        assert s.score(text) < toxicity.THRESHOLD, text


def readings(text, chars):
    """(log probability, words) of every path of a lattice, spelled out."""

    def go(i, words, cost):
        if i == len(text):
            yield cost, words
            return
        letters, drop, end, repeat, begin = toxicity.steps(text, i)
        inside = words and words[-1] != ""
        for letter, price in letters:
            yield from go(i + 1, [*words[:-1], (words[-1] if words else "") + letter], cost + price)
            if inside and words[-1][-1] == letter:
                yield from go(i + 1, words, cost + price + repeat)
            if inside and begin is not None:
                yield from go(i + 1, [*words, letter], cost + price + begin)
        if drop is not None:
            yield from go(i + 1, words, cost + drop)
        if end is not None:
            yield from go(i + 1, [*words, ""] if inside else words, cost + end)

    for cost, words in go(0, [""], 0.0):
        words = [w for w in words if w]
        padded = [toxicity._START + w + "$" for w in words]
        yield cost + sum(chars.log(p[i : i + 4], p[i + 4]) for p in padded for i in range(len(p) - 4)), " ".join(words)


@pytest.mark.parametrize("text", ["1d1", "0f", "th3", "m0r", "a b", "s.c", "loo", "aaa", "1 1", "t h.e", "no!", "i  d", "x9q", "$ c u", "oof a", ""])
def test_viterbi_equals_exhaustive_search(toxic_model, text):
    chars = toxicity.CharModel(dict(toxic_model.grams))
    best = max(readings(text, chars))
    got = toxicity.restored(text, chars)
    assert math.isclose(got[0], best[0], rel_tol=1e-9, abs_tol=1e-9) and any(w == got[1] and math.isclose(v, best[0], rel_tol=1e-9, abs_tol=1e-9) for v, w in readings(text, chars))


def test_character_model_is_a_distribution(toxic_model):
    chars = toxicity.CharModel(dict(toxic_model.grams))
    symbols = {g[-1] for g in dict(toxic_model.grams)}
    for context in ("^^^^", "^^^t", "^the", "heth", "zzzz"):
        assert 0.9 < sum(math.exp(chars.log(context, c)) for c in symbols) <= 1.0 + 1e-9


def test_index_finds_what_decoding_everything_finds(toxic_model):
    s = toxicity.Scorer(toxic_model)
    rng = random.Random(5)
    pieces = ["the", "of", "and", "with", "ting", "idiot", "1d10t", "m 0 r 0 n", "scuum", "tr@sh", "pathetic!", "(loser)", "cl.own", "stu pid", "12", "--"]
    for _ in range(60):
        text = " ".join(rng.choice(pieces) for _ in range(rng.randrange(1, 6)))
        whole = {w for w in toxicity.restored(text.lower(), s.chars)[1].split() if w in s.words}
        assert whole <= {f[2:] for f in s.found(text) if f[0] == "w"}, text


def test_score_is_a_noisy_or_and_selection_a_plain_one():
    model = toxicity.Model((("w:bad", 0.9), ("m:evil", 0.5), ("p:mean", 0.6)), tuple(toxicity.grams_of(Counter({"bad": 3, "evilly": 2, "meanest": 2, "the": 9})).items()), 0.1)
    s = toxicity.Scorer(model)
    assert math.isclose(s.score("the bad evilone evilly meanest"), 1 - 0.9 * 0.1 * 0.5 * 0.4)
    assert math.isclose(s.score("evilly evilly"), 0.1) and math.isclose(s.score("b.a.d"), 1 - 0.9 * 0.1)
    counts = {"a": (9, 0), "b": (4, 0), "c": (4, 9), "d": (3, 0), "e": (5, 1)}
    tails = {k: math.log(sum(math.comb(a + b, i) * 0.2**i * 0.8 ** (a + b - i) for i in range(a, a + b + 1))) for k, (a, b) in counts.items()}
    for k, (a, b) in counts.items():
        assert toxicity.log_tail(a, a + b, 0.2) >= tails[k] - 1e-9
    got, cut = toxicity.significant(counts, 0.2)
    able = sorted((toxicity.log_tail(a, a + b, 0.2), k) for k, (a, b) in counts.items() if a + b >= 4)
    assert got == {k for i, (p, k) in enumerate(able) if any(p2 <= math.log(0.05 * (j + 1) / len(able)) for j, (p2, _) in enumerate(able) if j >= i)} and "d" not in got
    assert cut == max(p for p, k in able if k in got)


def test_training_texts_are_restored_before_they_are_counted():
    clean = [(["the", "of", f"word{i}", "nice"], 0) for i in range(40)]
    toxic = [(["the", *(f"{c}{chr(97 + i)}{chr(98 + 2 * i)}" for c in "pqrstuvw"), "rotten" if i % 2 else "r0tten"], 1) for i in range(8)]
    model = toxicity.learned(clean + toxic, 1.0, 1.0)
    assert dict(model.lexicon)["w:rotten"] > 0.9
    assert toxicity.learned([], 1.0, 1.0).lexicon == ()


def test_every_labelled_document_is_learned_from(spark, make):
    """More documents of either class than any sample took: each counts, as in memory, copies once and each id once."""
    filler = ["stone", "river", "cloud", "field", "table", "light"]

    def text(i):
        own = f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}ish"
        bad = ("rotten" if i % 7 else "r0tten") if i % 2 == 0 and i % 3 else "vile" if i % 600 == 1 else "calm"
        return f"{filler[i % 6]} {own} {filler[i * 5 % 6]} {bad} {own}y."

    rows = [(i, text(i)) for i in range(9_000)] + [(20_000 + i, text(3)) for i in range(50)]
    marks = [(i, 1, int(i % 2 == 0 or i % 600 == 1)) for i, _ in rows]
    model = toxicity.fit(make(rows), spark.createDataFrame(marks, "doc_id long, quality int, toxic int"))
    learnable = [(t.lower().split(), m) for (i, t), (_, _, m) in zip(rows, marks, strict=True) if zlib.crc32(str(i).encode()) % 4 != 2]
    assert sum(1 for _, m in learnable if m) > 2_500 and sum(1 for _, m in learnable if not m) > 2_500
    plain = [{w for w in (x.strip(toxicity.EDGE) for x in t) if w.isalpha()} for t, _ in learnable]
    assert sum(n for g, n in model.grams if g[-1] == "$") == sum(map(len, plain))
    assert model == toxicity.learned(learnable, 1.0, 1.0)
    bad = {m: len({" ".join(t) for t, own in learnable if own == m and {"rotten", "r0tten"} & set(t)}) for m in (0, 1)}
    assert bad[0] == 0 and dict(model.lexicon)["w:rotten"] == bad[1] / (bad[1] + 0.5)


def test_fit_equals_learning_in_memory(spark, toxic_model):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = [((r["text"] or "").lower().split(), r["toxic"]) for r in docs.join(labels, "doc_id").filter("toxic is not null and crc32(cast(cast(doc_id as string) as binary)) % 4 != 2").orderBy("doc_id").collect()]
    assert toxic_model == toxicity.learned(rows, 1.0, 1.0) and toxic_model.lexicon


def test_tails_of_draws_from_few_documents_bound_exact_ones():
    for total, toxic in ((63, 9), (30, 20), (12, 12), (400, 7)):
        for n in range(1, min(total, 40)):
            for hits in range(max(1, n - total + toxic), min(n, toxic) + 1):
                exact = sum(math.comb(toxic, i) * math.comb(total - toxic, n - i) for i in range(hits, min(n, toxic) + 1)) / math.comb(total, n)
                got = toxicity.log_tail(hits, n, toxicity.rate_of(toxic, total - toxic), total)
                assert math.log(exact) - 1e-9 <= got <= 0 and (hits < n or got == 0 or math.isclose(got, math.log(exact), abs_tol=1e-9))


def test_toxic_near_copies_count_once(spark, make):
    """Words of a passage that was copied with small changes are not learned; those of as many different texts are."""
    passage = [f"{a}{b}ent" for a in "bcdfghjklm" for b in "aeiou"]
    near = [(i, " ".join([*passage[:k], f"{chr(97 + k)}zz", *passage[k + 1 :]])) for i, k in enumerate(range(3, 23))]
    other = [(100 + i, f"{chr(97 + i)}one {chr(98 + i)}two awful {chr(99 + i)}six {chr(97 + i)}ten") for i in range(20)]
    clean = [(1000 + i, f"{chr(97 + i % 26)}{chr(97 + i // 26)}day fine calm {chr(97 + i % 26)}sun") for i in range(200)]
    labels = spark.createDataFrame([(i, 0, int(i < 1000)) for i, _ in near + other + clean], "doc_id long, quality int, toxic int")
    lexicon = dict(toxicity.fit(make(near + other + clean), labels).lexicon)
    assert "w:awful" in lexicon and not {"w:" + w for w in passage} & set(lexicon)


def test_toxic_documents_of_held_out_rows(spark, toxic_model):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    n = {(r["toxic"], r["predicted"]): r["count"] for r in toxicity.scored(docs, toxic_model).join(labels, "doc_id").filter("held_out").groupBy("toxic", "predicted").count().collect()}
    assert n.get((0, 1), 0) <= 1 and n[1, 1] > n.get((1, 0), 0)


def test_lexicon_on_the_smallest_data(spark):
    small = SF.replace("sf0.01", "sf0.001")
    assert toxicity.fit(spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/labels.parquet")).lexicon


def test_toxicity_edges(spark, odd):
    labels = spark.createDataFrame([(None, 1, 1), (4, 1, None), (5, 1, 1), (-6, 0, 0)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(odd, labels)
    assert toxicity.scored(odd, model).count() == odd.count()
    kept = toxicity.accepted(odd, odd, labels.limit(0))
    assert kept.columns == odd.columns and kept.count() == odd.count()
    assert toxicity.scored(odd.limit(0), model).count() == 0


def test_one_text_of_a_repeated_id_is_learned_from(spark, make):
    docs = make([(i, f"some clean text number{i}") for i in range(20)] + [(100, f"vile{k} other") for k in range(50)])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)] + [(100, 1, 1), (100, 1, 0)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    assert sum(1 for g, _ in model.grams if g.startswith("^vile"[:5])) <= 1
    scores = {r["score"] for r in toxicity.scored(docs, model).filter("doc_id = 100").collect()}
    assert all(0 <= x <= 1 for x in scores)


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(3)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    tables = quality_gam.learned(x[:3000], y[:3000], np.ones(3000))
    assert ((tables.scores(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95
    by_hand = [tables.intercept + sum(v[np.searchsorted(c, row[j], side="right")] for j, (c, v) in enumerate(zip(tables.cuts, tables.values, strict=True))) + sum(v[np.searchsorted(ca, row[a], side="right"), np.searchsorted(cb, row[b], side="right")] for a, b, ca, cb, v in tables.pairs) for row in x[:20]]
    assert np.allclose(tables.log_odds(x[:20]), by_hand)


def test_quality_of_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = quality_gam.scored(docs, quality_gam.fit(docs, labels)).join(labels, "doc_id").filter("held_out")
    assert out.agg(F.avg((F.col("quality") == F.col("predicted")).cast("double"))).collect()[0][0] > 0.95


def test_quality_edges(spark, odd):
    labels = spark.createDataFrame([(None, 1, 1), (4, None, 1), (5, 1, 1), (-6, 0, 0)], "doc_id long, quality int, toxic int")
    for chosen in (labels, labels.limit(0)):
        out = quality_gam.scored(odd, quality_gam.fit(odd, chosen)).collect()
        assert len(out) == odd.count() and all(0 <= r["score"] <= 1 for r in out)
    assert quality_rules.apply(odd).count() == odd.count() and quality_rules.apply(odd.limit(0)).count() == 0


def test_base_score_and_counts_equal_plain_ones(spark, make, monkeypatch):
    monkeypatch.setattr(suffix_lm, "WORD_SHARE", 0.01)  # so that some words go the way of seldom ones
    rng = random.Random(11)
    rows = [(i, " ".join(rng.choice(["The", "of", "cat", "DOG", f"r{rng.randrange(99)}"]) for _ in range(rng.randrange(30)))) for i in range(120)] + [(500, None)]
    tokens = {i: [lower(x) for x in WORD.findall(t or "")] + ["\n"] for i, t in rows}
    train = Counter(w for i, ts in tokens.items() if zlib.crc32(str(i).encode()) % 5 != 1 for w in ts)
    n, v = sum(train.values()), len(train)
    for r in suffix_lm.scored(make(rows)).collect():
        ts = tokens[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (len(ts), sum(train[w] > 0 for w in ts), n, zlib.crc32(str(r["doc_id"]).encode()) % 5 == 1)
        assert math.isclose(r["base_score"], sum(math.log10((train[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ts), rel_tol=1e-9)
        assert r["score"] < 0


def counts_of(texts):
    w = tk.words(pa.array(texts))
    symbols, offsets = suffix_lm.stream(w)
    return w, symbols, offsets, np.unique(suffix_lm.gram_codes(symbols, offsets, 0, len(symbols)), return_counts=True)


def test_automaton_states_are_the_longest_retained_suffix(spark, monkeypatch):
    monkeypatch.setattr(suffix_lm, "BLOCK", 7)
    rng = random.Random(12)
    texts = [" ".join("".join(rng.choice("ab") for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(9))) for _ in range(60)]
    _, symbols, offsets, (codes, numbers) = counts_of(texts)
    grams = spark.createDataFrame([(int(c), int(n)) for c, n in zip(codes.view(np.int64), numbers, strict=True)], "code long, n long")
    counts = suffix_lm.retained(grams, int(numbers.sum()))
    model = suffix_lm.automaton(counts)
    got = suffix_lm.log_probabilities(symbols, offsets, model)
    tree = {}
    for ctx, nxt, n in zip(*(x.tolist() for x in counts), strict=True):
        depth = ctx >> 56
        tree.setdefault(bytes(ctx >> 8 * i & 255 for i in range(depth - 1, -1, -1)), Counter())[nxt] += n

    def prob(history, symbol):
        p = (tree[b""][symbol] + 128 / 256) / (sum(tree[b""].values()) + 128)
        for k in range(1, suffix_lm.DEPTH + 1):
            own = tree.get(history[len(history) - k :]) if len(history) >= k else None
            if own:
                p = (own[symbol] + suffix_lm.PRIOR * p) / (sum(own.values()) + suffix_lm.PRIOR)
        return p

    raw = symbols.tobytes()
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        for i in range(a, b):
            assert math.isclose(got[i], math.log10(prob(b"\n" + raw[a:i], raw[i])), rel_tol=1e-4, abs_tol=1e-5)
    # next-symbol distributions add up to one over all bytes
    width = int(model.classes.max()) + 1
    per_class = np.bincount(model.classes, minlength=width)
    total = (10.0 ** model.logs.reshape(-1, width)).sum(axis=1)
    assert np.allclose(total, 1, atol=1e-3) and per_class.sum() == 256


def test_score_is_a_probability_of_units(spark):
    """Spelled and named shares mix to the hand-made value, with empty texts between others."""
    texts = ["aa b", None, "b", "", "aa aa b"]
    w, symbols, offsets, _ = counts_of(texts)
    logs = -np.arange(1, len(symbols) + 1) / 10
    named = np.array([-1.0, -np.inf, -2.0, -1.0, -1.0, -2.0])
    got = suffix_lm.text_scores(logs, offsets, w, named, 0.25, 0.2)
    at = 0
    unit = 0
    for i, t in enumerate(texts):
        ws = (t or "").split()
        if not ws:
            assert math.isclose(got[i], logs[at])
            at += 1
            continue
        totals = [0.0, 0.0, 0.0]
        for k, word in enumerate(ws):
            spelled = logs[at : at + len(word) + 1].sum()
            at += len(word) + 1
            share = 10 ** named[unit] * (0.25 if k == len(ws) - 1 else 0.75)
            unit += 1
            for j, lam in enumerate((0.0, 0.5, 0.8)):
                totals[j] += math.log10(lam * share + (1 - lam) * 10**spelled)
        assert math.isclose(got[i], math.log10(sum(10**x for x in totals) / 3), rel_tol=1e-9)


def test_seldom_words_count_as_known_in_the_score(make, monkeypatch):
    rng = random.Random(13)
    rows = [(i, " ".join(rng.choice(["the", "of", "cat", f"r{rng.randrange(40)}", f"q{rng.randrange(4000)}"]) for _ in range(rng.randrange(30)))) for i in range(120)] + [(500, None)]
    scores = []
    for share in (4e-7, 0.01, 0.9):  # all words are frequent, some, none
        monkeypatch.setattr(suffix_lm, "WORD_SHARE", share)
        scores.append({r["doc_id"]: r["score"] for r in suffix_lm.scored(make(rows)).collect()})
    for d, score in scores[0].items():
        assert all(math.isclose(s[d], score, rel_tol=1e-9) for s in scores)


def test_scoring_edges(odd):
    out = suffix_lm.scored(odd).collect()
    assert len(out) == odd.count() and all(r["score"] <= 0 and r["n_known"] <= r["n_tokens"] for r in out)
    assert suffix_lm.scored(odd.limit(0)).count() == 0
