"""Line dedup, decontamination, mixing and URL filter against plain Python."""

import random
from fractions import Fraction
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from standbyspark.llm import decontamination, line_dedup, mixing, url_filter


def plain_dedup(rows, width=3, long_words=50):
    """rows: (doc_id, text) with different ids."""
    docs = sorted(rows)
    lines = {d: [(i, x.strip(" \t\r\x0b\x0c")) for i, x in enumerate(t.split("\n")) if x.strip(" \t\r\x0b\x0c")] for d, t in docs}
    seen, cut = set(), {d: set() for d, _ in docs}
    spans = []
    for d, _ in docs:
        own = lines[d]
        found = [(own[i][0], own[i + width - 1][0], tuple(x for _, x in own[i : i + width])) for i in range(len(own) - width + 1)]
        size = lambda lines: sum(len([w for w in x.split(" ") if w]) for _, x in lines)
        for n in range(1, width):
            found += [(own[i][0], own[i + n - 1][0], tuple(x for _, x in own[i : i + n])) for i in range(len(own) - n + 1) if size(own[i : i + n]) > long_words]
        spans += [(d, *f) for f in sorted(found, key=lambda f: f[0])]
    for d, lo, hi, what in spans:
        if what in seen:
            cut[d] |= set(range(lo, hi + 1))
        seen.add(what)
    return {d: "\n".join(x for i, x in enumerate(t.split("\n")) if i not in cut[d]) if cut[d] else t for d, t in rows}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_line_dedup_equals_plain(make, seed):
    rng = random.Random(seed)
    pool = [f"line {i} {'x ' * rng.randrange(5)}" for i in range(12)] + ["", "  ", " ".join(f"t{i}" for i in range(60)), " ".join(f"u{i}" for i in range(26)), "  ".join(f"v{i}" for i in range(26))]
    rows = [(d, "\n".join(rng.choice(pool) for _ in range(rng.randrange(1, 12)))) for d in rng.sample(range(500), 60)]
    got = line_dedup.deduplicated(make(rows), counts=("lines", "gone"))
    found = {r["doc_id"]: r["text"] for r in got.collect()}
    assert found == plain_dedup(rows)
    assert {r["doc_id"]: r["lines"] - r["gone"] for r in got.collect() if r["gone"] < r["lines"]} == {d: len(t.split("\n")) for d, t in found.items() if d in {r["doc_id"] for r in got.collect() if r["gone"] < r["lines"]}}


def test_long_passages_on_two_lines_are_seen(make):
    first, second = " ".join(f"p{i}" for i in range(25)), " ".join(f"q{i}" for i in range(40))
    rows = [(1, f"{first}\n{second}"), (2, f"a\n{first}\n{second}\nb"), (3, f"{first}\n{second}"), (4, f"{first}\nother"), (5, f"{second}\n{first}")]
    assert {r["doc_id"]: r["text"] for r in line_dedup.deduplicated(make(rows)).collect()} == {1: rows[0][1], 2: "a\nb", 3: "", 4: rows[3][1], 5: rows[4][1]}


def test_emptied_texts_go_only_if_asked(make):
    rows = [(1, "a\nb\nc"), (2, "a\nb\nc"), (3, "a\nb\nc\nd"), (4, ""), (5, None), (6, "a")]
    assert {r["doc_id"]: r["text"] for r in line_dedup.deduplicated(make(rows)).collect()} == {1: "a\nb\nc", 2: "", 3: "d", 4: "", 5: None, 6: "a"}
    assert {r["doc_id"] for r in line_dedup.deduplicated(make(rows), least_left=0).collect()} == {1, 3, 4, 5, 6}
    assert {r["doc_id"] for r in line_dedup.deduplicated(make(rows), least_left=0.2).collect()} == {1, 4, 5, 6}


def test_line_dedup_odd_rows(odd):
    out = line_dedup.deduplicated(odd)
    assert out.columns == odd.columns and sorted(map(str, out.collect())) == sorted(map(str, odd.collect()))
    assert line_dedup.deduplicated(odd.limit(0)).count() == 0


def prose(rng, n):
    return [rng.choice(["the", "of", "a"]) if rng.random() < 0.3 else f"w{rng.randrange(900)}" for _ in range(n)]


def test_benchmark_passages_are_found_despite_substitutions(spark, make):
    rng = random.Random(4)
    items = {i: prose(rng, rng.randrange(14, 40)) for i in range(12)}
    rows, expected = [], set()
    for d in range(90):
        own = prose(rng, rng.randrange(0, 120))
        kind = d % 6
        if kind < 4:
            item = rng.randrange(12)
            passage = items[item][:]
            if kind == 1:
                passage[rng.randrange(len(passage))] = "other"
            if kind == 2:
                passage = [w.title() + rng.choice(["", ".", ","]) for w in passage]
            if kind == 3 and len(passage) > 24:
                passage[3] = passage[17] = "else"
            at = rng.randrange(len(own) + 1)
            own[at:at] = passage
            expected.add((d, item))
        rows.append((d, rng.choice([" ", "\n", "  "]).join(own)))
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")
    got = decontamination.matches(make(rows), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == expected
    kept = decontamination.clean(make(rows), bench)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(range(90)) - {d for d, _ in expected})


@pytest.mark.parametrize("length", [10, 11, 12, 13])
def test_some_mask_spares_all_substitutions_that_are_accepted(length):
    masks = decontamination.MASKS if length >= decontamination.WINDOW else (*decontamination.MASKS, decontamination.SHORT_MASK)
    placed = [{at + k for k in mask} for mask in masks for at in range(length - mask[-1])]
    for other in combinations(range(length), length * (100 - decontamination.SHARE) // 100):
        assert any(p.isdisjoint(other) for p in placed), other


def test_passages_with_every_fourth_token_replaced_are_found(spark, make):
    rng = random.Random(9)
    items = {1: prose(rng, 40), 2: [f"u{i}" for i in range(12)]}
    rows = [(10 * i + r, " ".join(f"x{k}" if k % 4 == r else w for k, w in enumerate(items[i]))) for i in items for r in range(4)]
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")
    got = decontamination.matches(make([*rows, (99, " ".join(prose(rng, 60)))]), bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(d, d // 10) for d, _ in rows}


def tokens(text):
    return "".join(" " if c in decontamination.PUNCTUATION else c for c in text.lower()).split()


def all_pairs(rows, items):
    """(doc, item) of every contaminated pair by comparing every alignment, without seeds."""
    found = set()
    for d, text in rows:
        own = tokens(text)
        for i, item in items.items():
            b = tokens(item)
            for shift in range(-len(b) + 1, len(own)):
                eq = [own[j + shift] == b[j] for j in range(max(0, -shift), min(len(b), len(own) - shift))]
                width = min(13, len(eq))
                best = max(sum(eq[k : k + width]) for k in range(len(eq) - width + 1))
                near = width >= min(13, len(b)) and width >= 10 and best * 100 >= 75 * width
                exact = best == width and (width >= 5 and width in (len(b), len(own)) or width == len(b) == len(own))
                if near or exact:
                    found.add((d, i))
    return found


@pytest.mark.parametrize("seed", [1, 2])
def test_decontamination_equals_the_comparison_of_all_alignments(spark, make, seed):
    rng = random.Random(seed)
    items = {i: " ".join(prose(rng, rng.choice([1, 2, 3, 4, 5, 6, 8, 9, 10, 11, 12, 13, 14, 20, 40]))) for i in range(40)}
    rows = []
    for d in range(150):
        passage = items[rng.randrange(40)].split()
        if rng.random() < 0.5:  # a part of it
            lo = rng.randrange(len(passage))
            passage = passage[lo : lo + rng.randrange(1, 20)]
        for _ in range(rng.randrange(5)):
            passage[rng.randrange(len(passage))] = f"e{rng.randrange(9)}"
        around = 0 if rng.random() < 0.4 else 30
        rows.append((d, " ".join([*prose(rng, rng.randrange(around + 1)), *(w.title() + rng.choice(["", ",", "'"]) for w in passage), *prose(rng, rng.randrange(around + 1))])))
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.matches(make(rows), bench).collect()}
    assert got == all_pairs(rows, items)


def test_short_items_and_documents_are_compared_exactly(spark, make):
    bench = spark.createDataFrame([(1, "what is the capital of France?"), (2, "Yes."), (3, " ".join(f"k{i}" for i in range(30)))], "item_id long, text string")
    rows = [(1, "so what is the capital of france then"), (2, "what is the capital of spain"), (3, "yes"), (4, "yes it is"), (5, " ".join(f"k{i}" for i in range(9, 18))), (6, " ".join(f"k{i}" for i in range(9, 13))), (7, "k1 k2 k3 k4 k5 but more of it and other words still")]
    assert {(r["doc_id"], r["item_id"]) for r in decontamination.matches(make(rows), bench).collect()} == {(1, 1), (3, 2), (5, 3)}


def test_a_full_bitset_changes_nothing(spark, make, monkeypatch):
    rng = random.Random(8)
    item = prose(rng, 20)
    docs, bench = make([(1, " ".join(prose(rng, 30) + item)), (2, " ".join(prose(rng, 50)))]), spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    first = decontamination.matches(docs, bench).collect()
    monkeypatch.setattr(decontamination, "BITS", 64)
    assert decontamination.matches(docs, bench).collect() == first and [(r["doc_id"], r["item_id"], r["n_equal"]) for r in first] == [(1, 7, 20)]


def test_decontamination_odd_rows(spark, odd):
    bench = spark.createDataFrame([(None, None), (1, ""), (2, "too short"), (3, " ".join(f"q{i}" for i in range(30)))], "item_id long, text string")
    assert decontamination.matches(odd, bench).count() == 0
    kept = decontamination.clean(odd, bench)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    assert decontamination.matches(odd.limit(0), bench).count() == 0 and decontamination.clean(odd, bench.limit(0)).count() == odd.count()


def edf(weights):
    period, done, picks = sum(weights), [0] * len(weights), []
    for t in range(period):
        ready = [(-(-(d + 1) * period // n), g) for g, (d, n) in enumerate(zip(done, weights, strict=True)) if d < n and d * period // n <= t]
        g = min(ready)[1]
        picks.append(g)
        done[g] += 1
    return picks


@pytest.mark.parametrize("weights", [[1], [1, 1], [3, 5, 2], [10, *[4] * 19, 14], [50, 1, 1, 7, 13]])
def test_schedule_is_edf_and_deviates_less_than_a_block(spark, weights):
    rows = mixing.schedule(spark, weights).orderBy("slot").collect()
    picks = [r["grp"] for r in rows]
    assert picks == edf(weights)
    period = sum(weights)
    for t in range(period + 1):
        for g, n in enumerate(weights):
            assert abs(Fraction(t * n, period) - picks[:t].count(g)) < 1


def test_mix_keeps_every_row_and_follows_the_weights(make):
    rng = random.Random(6)
    rows = [(i, "x", "en", rng.choice(["a", "a", "a", "b", "c", None])) for i in range(3000)]
    got = mixing.mixed(make(rows), {"a": 2, "b": 3}, 5, block_rows=8).orderBy("mix_pos").collect()
    assert [r["mix_pos"] for r in got] == list(range(3000)) and {r["doc_id"] for r in got} == set(range(3000))
    assert all(r["mix_release"] <= r["mix_slot"] < r["mix_deadline"] for r in got)
    alive = min(max(r["mix_pos"] for r in got if r["mix_group"] == g) for g in ("a", "b", "other"))
    for n in range(0, alive, 80):
        part = [r["mix_group"] for r in got[:n]]
        assert all(abs(part.count(g) - n * w / 10) <= 16 for g, w in (("a", 2), ("b", 3), ("other", 5)))


def test_mix_odd_rows(odd):
    out = mixing.mixed(odd, {"src0": 1}, 1)
    assert out.count() == odd.count() and out.columns[: len(odd.columns)] == odd.columns and len({c.lower() for c in out.columns}) == len(out.columns)
    assert mixing.mixed(odd.limit(0), {"src0": 1}, 1).count() == 0
    with pytest.raises(ValueError):
        mixing.mixed(odd, {"src0": 0}, 1)
    with pytest.raises(ValueError):
        mixing.mixed(odd, {"src0": mixing.MAX_PERIOD}, 1)


RULES = dict(url_filter.RULES)


def by_hand(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    end = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    stop = min([i for i in (path.find(c) for c in "?#") if i >= 0], default=len(path))
    path = path[:stop]
    fits = [r for r in RULES if (host == r.partition("/")[0] or host.endswith("." + r.partition("/")[0])) and path.startswith("/" + r.partition("/")[2])]
    return host, path, max(fits, key=len, default=None)


def test_url_rules_and_mined_rules(spark):
    rng = random.Random(2)
    urls = [None, "", "no scheme", "http://", "HTTP://Example.COM/en/7x?a=b#c", "x://net", "http://a.net/de/", "http://example.net/de/81", "http://org/es/", "http://borg/es/", "http://com?x/en/", "http://a.com/en", "a://b://c/d", "http://é.com/en/\n1"]
    urls += [f"https://{'www.' * rng.randrange(2)}{rng.choice(['bad-shop', 'good-site', 'news'])}.example.{rng.choice(['org', 'net'])}/{rng.choice(['fr', 'it'])}/{i}" for i in range(400)]
    pages = spark.createDataFrame([(i, u, i) for i, u in enumerate(urls)] + [(None, None, 1), (9, urls[9], 2), (9, urls[9], 2)], "page_id long, url string, items long")
    labelled = spark.createDataFrame([(u, "bad-shop" in u) for i, u in enumerate(urls) if u and "example" in u and i % 2], "url string, bad boolean")
    got = url_filter.judged(pages, labelled).collect()
    assert len(got) == pages.count()
    for r in got:
        if r["page_id"] is not None:
            url = urls[r["page_id"]]
            assert (r["host"], r["path"], r["rule"]) == by_hand(url)
            expected = RULES[r["rule"]] if r["rule"] else "block" if "bad-shop" in (url or "") else "allow"
            assert r["verdict"] == expected, url
    assert url_filter.judged(pages.limit(0), labelled).count() == 0
    assert {r["verdict"] for r in url_filter.judged(pages, labelled.limit(0)).filter("rule is null").collect()} == {"allow"}


def enumerated(rows, min_support, min_confidence, min_count, sigmas):
    """Rules of all token subsets, by counting every one."""
    total, n_bad, freq, bad_freq = len(rows), sum(b for _, b in rows), {}, {}
    for tokens, is_bad in rows:
        own = sorted(set(tokens))
        for k in range(1, len(own) + 1):
            for items in combinations(own, k):
                freq[items] = freq.get(items, 0) + 1
                bad_freq[items] = bad_freq.get(items, 0) + is_bad
    rate, found = n_bad / total, {}
    for items, n in freq.items():
        b = bad_freq[items]
        if b >= min_count and b >= -(-min_support * total // 1) and b / n >= min_confidence and b - n * rate >= sigmas * (n * rate * (1 - rate)) ** 0.5:
            found[items] = b / n
    return {items: c for items, c in found.items() if not any(set(q) < set(items) and d >= c for q, d in found.items())}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_mined_rules_equal_an_exhaustive_enumeration(spark, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(300):
        tokens = ["s:https", *rng.sample(["a", "b", "c", "d", "e", "f"], rng.randrange(1, 6))]
        rows.append((tokens, ({"a", "b"} <= set(tokens) or {"c", "d", "e"} <= set(tokens)) != (rng.random() < 0.05)))
    mined = url_filter.mined_rules(spark.createDataFrame(rows, "tokens array<string>, bad boolean"), 0.01, 0.8, 5, 3.0)
    expected = enumerated([([t for t in ts if t != "s:https"], b) for ts, b in rows], 0.01, 0.8, 5, 3.0)
    assert {tuple(r["items"]): r["confidence"] for r in mined.collect()} == expected and len(expected) > 1


def test_rules_of_chance_are_dropped(spark):
    rows = [(["a"], i < 6) for i in range(7)] + [(["z"], i % 2 == 0) for i in range(200)]
    assert url_filter.mined_rules(spark.createDataFrame(rows, "tokens array<string>, bad boolean"), 0.001, 0.8).count() == 0


def test_tokens_hold_each_fact_once(spark):
    urls = spark.createDataFrame([(0, "https://www.Bad-shop.example.org/en/bet365/12.html?utm=1&x=2"), (1, "http://com/"), (2, None), (3, "no")], "i int, url string")
    got = [r[1] for r in urls.select("i", url_filter.tokens(F.col("url"))).orderBy("i").collect()]
    assert sorted(got[0]) == sorted(["h:www", "h:bad", "h:shop", "h:example", "t:org", "p:en", "p:bet365", "p:html", "q:utm", "q:x", "e:html", "s:https"])
    assert sorted(got[1]) == ["s:http", "t:com"] and got[2:] == [[], []]


def test_rules_need_all_tokens_and_prefer_the_short(spark):
    rows = [(["a", "b"], True)] * 30 + [(["a", "c"], False)] * 60 + [(["b", "d"], False)] * 60 + [(["z", "b"], True)] * 20
    mined = url_filter.mined_rules(spark.createDataFrame(rows, "tokens array<string>, bad boolean"), 0.01, 0.9)
    assert sorted(sorted(r["items"]) for r in mined.collect()) == [["a", "b"], ["z"]]


def test_labels_of_pages(spark):
    pages = spark.createDataFrame([("http://a.example/en/12.html",), ("http://casino-x.example/en/13",), ("http://a.example/en/14",), (None,), ("http://a.example/en/99999999999999999999",)], "url string")
    labels = spark.createDataFrame([(12, 0, 0), (14, 1, 0), (14, None, 1), (None, 0, 0)], "doc_id long, quality int, toxic int")
    got = {r["url"]: r["bad"] for r in url_filter.labels_of_pages(pages, labels).collect()}
    assert got == {"http://a.example/en/12.html": True, "http://casino-x.example/en/13": None, "http://a.example/en/14": True, None: None, "http://a.example/en/99999999999999999999": None}
