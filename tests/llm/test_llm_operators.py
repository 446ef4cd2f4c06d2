"""Operators for training data against brute force, on small tables with nulls, empties, ties and copies."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from faremill.llm import (
    cutting_stock,
    decontaminate,
    graph,
    html_blocks,
    html_extract,
    jaccard_join,
    katz,
    licences,
    packing,
    quality_rules,
    resampling,
    segments,
    sharding,
    toxicity,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.integers(vocabulary)}x" for _ in range(n))


def frame(spark, texts):
    """Documents numbered from 0; a pair gives its own id."""
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and blank texts, a very long one, ties, repeated rows, a clashing column."""
    rng = np.random.default_rng(3)
    long = prose(rng, 20_000, 5_000)
    same = prose(rng, 60)
    texts = [None, "", " \n\t", "one", long, same, same, (5, same), (None, same), (None, None), (7, "short text here")]
    return frame(spark, texts).withColumn("__words", F.lit("mine")).withColumn("score", F.lit(None).cast("string"))


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# sharding


def test_shards_balance_bytes_and_number_gaplessly(spark):
    rng = np.random.default_rng(1)
    docs = frame(spark, [prose(rng, int(n)) for n in rng.integers(1, 300, 400)])
    got = sharding.shard_documents(docs, shards=5, slots=256).toPandas()
    totals = got.groupby("shard")["size"].sum()
    assert totals.max() - totals.min() <= 0.02 * totals.mean()
    assert all(sorted(g) == list(range(len(g))) for _, g in got.groupby("shard")["slot"])
    assert set(got["law"]) == {"bytes"} and got["grown_shard"].isna().all()


def test_shards_of_odd_and_empty(spark, odd, empty):
    got = sharding.shard_documents(odd, shards=3, slots=16).collect()
    assert len(got) == odd.count() and min(r.size for r in got) == 1
    assert {r.text_crc32 for r in got if r.size == 1} == {0}
    assert sharding.shard_documents(empty).count() == 0


def test_growing_moves_slots_into_the_new_shard_only():
    rng = np.random.default_rng(2)
    sizes = rng.integers(0, 1000, 512)
    before = sharding.rebalance(sharding.first_map(512, 4), sizes, 4)
    after = sharding.grow(before, sizes, 4)
    assert set(after[after != before]) == {4}
    load = np.bincount(after, weights=sizes)
    assert load[4] == pytest.approx(sizes.sum() / 5, rel=0.05)


# quality rules


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed)


def test_rule_counters_match_brute_force(spark, odd):
    rng = np.random.default_rng(4)
    twice = prose(rng, 9)
    texts = [prose(rng, 50), f"{twice}\n{twice}\n{prose(rng, 30)}", "a " * 40, "# | x\n# | x\n\n# | x", "é\x0bü\x0cß x" * 9, "  x"]
    docs = frame(spark, texts)
    got = {r.doc_id: tuple(r)[1:-1] for r in quality_rules.rule_report(docs).collect()}
    assert got == {i: base_counts(t) for i, t in enumerate(texts)}
    report = quality_rules.rule_report(odd).collect()
    assert Counter(tuple(r)[1:-1] for r in report) == Counter(base_counts(r.text) for r in odd.collect())


def test_rules_keep_prose_and_reject_junk_in_any_order(spark):
    rng = np.random.default_rng(5)
    good = [f"Zum Tage {prose(rng, 80)}. Ende." for _ in range(5)]
    junk = ["word$$$ other### " * 15 + prose(rng, 10), " ".join(w.upper() + "!!" for w in prose(rng, 60).split()), ("ha " * 7 + "ho " * 7) * 4]
    docs = frame(spark, good + junk)
    rules = quality_rules.default_rules()
    for order in (rules, rules[::-1]):
        kept = {r.doc_id for r in quality_rules.judge(docs, order).where("kept").collect()}
        assert kept == set(range(5))
    assert {r.doc_id for r in quality_rules.keep_good(docs).collect()} == set(range(5))


def test_rules_leave_other_columns_and_take_empty_tables(spark, odd, empty):
    kept = quality_rules.keep_good(odd)
    assert kept.columns == odd.columns and {r["__words"] for r in kept.collect()} == {"mine"}
    assert quality_rules.rule_report(empty).count() == 0 and quality_rules.keep_good(empty).count() == 0


# toxicity


def toxic_fixture(spark, n=700):
    rng = np.random.default_rng(6)
    texts, toxic = [], []
    for i in range(n):
        bad = i % 4 == 0
        words = prose(rng, 60).split()
        if bad:
            words[10:10] = ["you", "snark", "grumble"] if i % 8 else ["idiot", "snark"]
        texts.append(" ".join(words))
        toxic.append(int(bad))
    labels = spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic)], "doc_id long, quality int, toxic int")
    return frame(spark, texts), labels, toxic


def test_toxicity_on_held_out_rows(spark):
    docs, labels, toxic = toxic_fixture(spark)
    got = toxicity.score_documents(docs, labels).toPandas().sort_values("doc_id")
    assert list(got["held_out"]) == [zlib.crc32(str(i).encode()) % 5 == 0 for i in range(len(toxic))]
    assert got["score"].between(0, 1).all() and ((got["score"] >= 0.5) == (got["predicted"] == 1)).all()
    held = got[got["held_out"]]
    right = [toxic[i] == p for i, p in zip(held["doc_id"], held["predicted"])]
    assert np.mean(right) >= 0.95
    kept = {r.doc_id for r in toxicity.keep_clean(docs, labels).collect()}
    assert kept == set(got[got["predicted"] == 0]["doc_id"])


def test_toxicity_without_labels_and_on_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.score_documents(odd, labels)
    assert got.count() == odd.count() and {r.score for r in got.collect()} == {0.0}
    assert toxicity.keep_clean(odd, labels).columns == odd.columns
    assert toxicity.score_documents(empty, labels).count() == 0


def test_obfuscated_words_are_seen():
    weights = toxicity._Weights(toxicity.Lexicon({"idiot": 3.0}, {}))
    at = toxicity.FEATURES.index
    assert toxicity.features("an id1ot", weights)[at("hidden_hits")] > 0
    assert toxicity.features("i d i o t", weights)[at("hidden_hits")] > 0
    near = toxicity.features("you idiot and more", weights)[at("second_near")]
    assert near > toxicity.features("you and many more idiot", weights)[at("second_near")] > 0


# Jaccard join


def brute_components(texts, k, percent):
    sets = {}
    for i, t in enumerate(texts):
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[a : a + k]) for a in range(max(1, len(w) - k + 1))} if w else set()
    label = list(range(len(texts)))
    for a in sets:
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = [new if x == old else x for x in label]
    return {i: (len(sets[i]), label[i]) for i in sets}


def edited(rng, text, n):
    words = text.split()
    for at in rng.integers(0, len(words), n):
        words[at] = f"e{rng.integers(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize(("k", "percent"), [(4, 85), (5, 80)])
def test_join_matches_brute_force(spark, k, percent):
    rng = np.random.default_rng(7)
    texts = [None, "", "one", "One", "two words", "two  words"]
    for n in (8, 14, 25, 45, 90, 200):
        for _ in range(3):
            origin = prose(rng, n, 10_000)
            texts += [origin, origin.upper(), *(edited(rng, origin, e) for e in (1, 1, 2, 3)), f"{origin} tail", f"x {origin}"]
    # a passage in many texts, and a family whose members link through their origin alone
    passage = prose(rng, 60, 10_000)
    texts += [f"{prose(rng, 60, 10_000)} {passage}" for _ in range(40)]
    origin = prose(rng, 150, 10_000)
    family = [edited(rng, origin, e) for e in (2, 3, 4, 5) for _ in range(30)]
    texts += family[:60] + [origin] + family[60:] + [edited(rng, family[-1], 1), edited(rng, family[-1], 1)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.join_documents(frame(spark, texts), k, percent).collect()}
    assert got == brute_components(texts, k, percent)


def test_linked_sets_share_more_than_the_spare_signatures():
    rng = np.random.default_rng(8)
    for percent in (80, 85):
        for _ in range(1500):
            a = np.unique(rng.integers(0, 1 << 62, int(rng.integers(3, 300))).astype(np.uint64))
            out = int(rng.integers(0, len(a) // 6 + 1))
            b = np.unique(np.concatenate([rng.permutation(a)[out:], rng.integers(0, 1 << 62, out // 2).astype(np.uint64)]))
            common = len(np.intersect1d(a, b))
            if common < len(np.union1d(a, b)) and 100 * common >= percent * (len(a) + len(b) - common):
                both = np.intersect1d(segments.signatures(a, percent), segments.signatures(b, percent))
                part = segments.partitions_of(min(len(a), len(b)), percent)[0]
                assert (both & 255 == part.band).sum() > part.spare


def test_keep_one_of_each_component(spark, odd, empty):
    kept = jaccard_join.keep_one(odd)
    assert kept.columns == odd.columns
    rows = Counter((r.doc_id, r.text) for r in kept.collect())
    same = odd.where("doc_id = 5").first().text
    assert [n for (_, t), n in rows.items() if t == same] == [1] and (5, same) in rows
    assert rows[(None, None)] == 1 and rows[(0, None)] == 1  # empty texts are nobody's copies
    assert jaccard_join.keep_one(empty).count() == 0 and jaccard_join.join_documents(empty).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3)]
    got = dict(map(tuple, graph.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}}


# decontamination


def test_windows_match_brute_force(spark):
    rng = np.random.default_rng(9)
    items = [prose(rng, n, 3000) for n in (14, 30, 55)] + [None, "", "just two", prose(rng, 30, 3000)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    texts = [prose(rng, 200, 3000) for _ in range(30)] + [None, "", "Just two", "just two more"]
    for i, at in ((0, 3), (1, 5), (2, 0), (6, 9)):
        words = texts[at].split()
        texts[at] = " ".join(words[:50] + [items[i].upper()] + words[50:])
    words = items[2].split()
    texts[20] = f"start {' '.join(words[:52])} other end {texts[20]}"  # 48 of its 51 shingles
    texts[21] = f"{texts[21]} {' '.join(words[:30])}"  # half of it
    docs = frame(spark, texts)
    got = {(r.doc_id, r.item_id) for r in decontaminate.report(docs, bench).collect()}
    assert got == {(3, 0), (5, 1), (0, 2), (9, 6), (20, 2), (32, 5)}
    kept = {r.doc_id for r in decontaminate.keep_untouched(docs, bench).collect()}
    assert kept == set(range(len(texts))) - {3, 5, 0, 9, 20, 32}


def test_decontamination_of_odd_and_empty(spark, odd, empty):
    bench = spark.createDataFrame([(1, "one"), (2, None), (None, "short text here")], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.report(odd, bench).collect()} == {(3, 1)}
    assert decontaminate.keep_untouched(odd, bench).columns == odd.columns
    assert decontaminate.keep_untouched(empty, bench).count() == 0
    none = bench.limit(0)
    assert decontaminate.keep_untouched(odd, none).count() == odd.count()


# Katz backoff


def katz_by_hand(texts, order):
    """(tokens, held out, counts of words, log10 scores) by plain recursion over contexts of up to order - 1 words."""
    tokens = [[*(t or "").encode().lower().split(), b""] for t in texts]
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))]
    seen = defaultdict(Counter)

    def contexts(t, at):
        line = [None, *t]
        return [tuple(line[max(0, at + 1 - n) : at + 1]) for n in range(min(order, at + 2))]

    for t, h in zip(tokens, held):
        for at, w in enumerate(t if not h else ()):
            for c in contexts(t, at):
                seen[c][w] += 1
    times = lambda counts: np.asarray([sum(c == r for c in counts) for r in range(1, 7)])
    d = [katz.discounts(times([c for h, x in seen.items() if len(h) == n for c in x.values()])) for n in range(order)]
    cut = lambda c, n: c * (d[n][c] if c <= 5 else 1)
    total = sum(seen[()].values())
    rest = 1 - sum(cut(c, 0) for c in seen[()].values()) / total
    below = {h: sum(x.values()) + all(c > 5 for c in x.values()) for h, x in seen.items() if h}
    back = {}

    def p(h, w):
        if not h:
            return cut(seen[()][w], 0) / total if w in seen[()] else rest
        if w in seen.get(h, ()):
            return cut(seen[h][w], len(h)) / below[h]
        return p(h[1:], w) * back.get(h, 1)

    for h in sorted(below, key=len):
        left = 1 - sum(p(h, w) for w in seen[h])
        back[h] = left / (1 - sum(p(h[1:], w) for w in seen[h]))
        assert sum(p(h, w) for w in seen[()]) + back[h] * (p(h[1:], b"never seen")) == pytest.approx(1)
    scores = [sum(math.log10(p(contexts(t, at)[-1], w)) for at, w in enumerate(t)) for t in tokens]
    return tokens, held, seen[()], scores


@pytest.mark.parametrize(
    "order,deal", [(3, {}), (3, {"hot": 30, "split_tokens": 40, "part_tokens": 500}), (3, {"hot": 0}), (2, {}), (2, {"hot": 30, "split_tokens": 40})]
)
def test_scores_match_brute_force_and_add_up(spark, order, deal):
    rng = np.random.default_rng(10)
    zipf = lambda n: " ".join(f"w{min(int(rng.zipf(1.4)), 500)}" for _ in range(n))
    texts = [zipf(int(n)) for n in rng.integers(1, 80, 150)] + [None, "", "new Words only", "w1 W1 w1", "w1 " * 900]
    tokens, held, uni, scores = katz_by_hand(texts, order)
    n, v = sum(uni.values()), len(uni)
    got = {r.doc_id: r for r in katz.score(frame(spark, texts), order=order, **deal).collect()}
    for i, t in enumerate(tokens):
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(t), sum(w in uni for w in t), n)
        assert r.base_score == pytest.approx(sum(math.log10((uni[w] + 1) / (n + v + 1)) for w in t))
        assert r.score == pytest.approx(scores[i])


def test_katz_counts_split_pairs_in_one_pass_without_a_join(spark, monkeypatch):
    """Every part's pairs with a split word got their totals by a join with themselves, after a pass of their own."""
    passes, held, pairs_of, split_totals = [], [], katz._pairs_of, katz._split_totals
    monkeypatch.setattr(katz, "_pairs_of", lambda *a, **b: passes.append(a) or pairs_of(*a, **b))
    monkeypatch.setattr(katz, "_split_totals", lambda pairs: held.append((pairs, split_totals(pairs))) or held[-1][1])
    texts = [f"a b{i % 7} a c a b{i % 3}" for i in range(200)]
    assert katz.score(frame(spark, texts), hot=30, split_tokens=40, part_tokens=500).count() == 200
    pairs, totals = held[0]
    assert len(passes) == len(held) == 1 and "Join" not in totals._jdf.queryExecution().executedPlan().toString()
    rows, sums = totals.collect(), {(r.v, r.w): r.n for r in pairs.groupBy("v", "w").agg(F.sum("c").alias("n")).collect()}
    assert len(rows) > len(sums) > 0 and len(rows) == pairs.count()
    assert all(r.c == sums[r.v, r.w] for r in rows) and sum(r.first for r in rows) == len(sums)


def test_katz_of_odd_rows(spark, odd):
    assert katz.score(odd).count() == odd.count()
    with pytest.raises(ValueError):
        katz.score(odd, order=1)


def test_katz_of_an_empty_table(empty):
    assert katz.score(empty).count() == 0


# packing


def ids_of(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def test_packing_places_every_id_once(spark, odd):
    rng = np.random.default_rng(11)
    tricky = ["Don't stop... 3.14, né!! İstanbul ΟΔΟΣ a,b.c ,.;", "<|endoftext|>x <|startoftext|>", "tab\tbell\x1cnext\x85line", "北京 é"]
    texts = [prose(rng, int(n)) for n in rng.integers(1, 900, 60)] + tricky + [None, ""]
    docs = frame(spark, texts)
    got = packing.pack(docs).toPandas()
    for i, text in enumerate(texts):
        ids = ids_of(text)
        mine = got[got["doc_id"] == i].sort_values("start")
        assert mine["length"].sum() == len(ids) and set(mine["doc_tokens"]) == {len(ids)}
        at = 0
        for row in mine.itertuples():
            assert row.start == at and zlib.crc32(np.asarray(ids[at : at + row.length], "<u4").tobytes()) == row.ids_crc32
            at += row.length
    for _, rows in got.groupby("sequence_id"):
        rows = rows.sort_values("offset")
        ends = rows["offset"] + rows["length"]
        assert list(rows["offset"]) == [0, *ends[:-1]] and ends.max() <= packing.LENGTH
    assert len(got) - 1 >= got["sequence_id"].max() >= math.ceil(got["length"].sum() / packing.LENGTH) - 1
    assert packing.pack(odd).where("start = 0").count() == odd.count()


def test_packing_of_an_empty_table(empty):
    assert packing.pack(empty).count() == 0


def test_patterns_hold_exactly_the_histogram_and_come_near_the_bound():
    rng = np.random.default_rng(12)
    sizes = {int(s): int(n) for s, n in zip(range(1, 33), rng.integers(0, 3000, 32))}  # above half, the volume is no bound
    plan = cutting_stock.cut(sizes, 64)
    held = Counter()
    for copies, counts in plan:
        assert sum(s * c for s, c in counts.items()) <= 64
        held.update({s: copies * c for s, c in counts.items()})
    assert held == Counter({s: n for s, n in sizes.items() if n})
    assert sum(c for c, _ in plan) <= 1.01 * sum(s * n for s, n in sizes.items()) / 64 + 64
    assert cutting_stock.cut({}, 64) == []


# extraction


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<div class="topbar">Log in</div><nav><ul><li><a href=/a>menu</a></ul></nav><div id="cookie-notice">We use cookies</div>
<div class="wrap-%d"><div class="post"><h1>A &amp; B</h1><p>First <b>bold</b>&nbsp;text,
 broken  line<p>Second &lt;x&gt; <a href=x>link</a> end.<ul><li>one<li>two</ul><form><input> Mail</form></div>
<div class="comments"><p>a long comment that nobody needs to keep at all, as it is not the article</div></div>
<aside>side</aside><script>if (a<b) "</p>"</script><footer>foot</footer></body></html>"""
TEXT = "A & B\nFirst bold text, broken line\nSecond <x> link end.\none\ntwo"


def test_extraction_by_host_consensus(spark):
    short = '<body><div class="wrap-9"><div class="post"><p>ok</div><div class="box"><p>something longer that only this page has</div></div>'
    pages = [(i, f"https://Host.example/{i}", PAGE % i) for i in range(6)] + [(6, "http://host.example:80/x", short)]
    pages += [(7, None, None), (8, "nonsense", ""), (9, "http://x.y/", "plain &copy; text"), (None, "http://host.example/", "<p>cut <a hr")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    got = {r.page_id: r for r in html_extract.extract(frame).collect()}
    assert all(got[i].text == TEXT for i in range(6))
    assert got[6].text == "ok"  # the host's path wins over the page's own longest container
    assert (got[7].text, got[8].text, got[9].text, got[None].text) == ("", "", "plain © text", "cut")
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert html_extract.extract(frame.limit(0)).count() == 0


def test_blocks_of_broken_markup():
    texts = lambda html: [b.text for b in html_blocks.blocks_of(html)]
    assert texts("<p><b>a<br>b<p>c</b></p></div>d<!-- x") == ["a b", "c", "d"]
    assert texts("<article><header><h1>t</h1><p>by me</header><p>x</article>") == ["t", "x"]
    assert texts("a < b &amp c<script>never ends") == ["a < b & c"]


# resampling and licences


def test_resampling_prefers_text_like_the_target(spark, odd, empty):
    rng = np.random.default_rng(13)
    texts = [prose(rng, 80, 200) if i % 2 else " ".join(f"$j{rng.integers(50)}$" for _ in range(80)) for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(0, 200, 3)], "doc_id long, quality int, toxic int")
    got = resampling.resample(frame(spark, texts), labels).toPandas()
    assert set(got[got["kept"]]["doc_id"] % 2) == {1} and got["kept"].sum() == 100
    top = resampling.resample(frame(spark, texts), labels, share=0.25).toPandas()
    bar = np.sort(top["gumbel_key"])[::-1][49]
    assert set(top[top["kept"]]["doc_id"]) == set(top[top["gumbel_key"] >= bar]["doc_id"])
    assert resampling.resample(odd, labels).count() == odd.count() and resampling.resample(empty, labels).count() == 0


def test_licence_lines(spark, odd, empty):
    texts = [f"some text\n{licences.NOTICES['MIT']}\nmore", "ALL RIGHTS RESERVED", None, "rights", f"x {licences.NOTICES['GPL-3.0']}", "the mit way"]
    got = {(r.doc_id, r.notice) for r in licences.scan(frame(spark, texts)).collect()}
    assert {(0, "MIT"), (1, "proprietary"), (4, "GPL-3.0")} <= got and {d for d, _ in got} == {0, 1, 4}
    assert licences.scan(odd).count() == 0 and licences.scan(empty).count() == 0
    assert Row(doc_id=1, dice=1.0) in licences.scan(frame(spark, texts)).select("doc_id", "dice").collect()


def test_licences_in_wrapped_lines_long_sentences_and_whole_texts(spark):
    rng = np.random.default_rng(12)
    wrapped = """ * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version."""
    grant = " ".join(licences.BODIES["MIT-text"].split("\n")[1:6])
    inside = f"{prose(rng, 40)} it is licensed under the Apache License, Version 2.0, {prose(rng, 40)}"
    repeated = " ".join(["all rights reserved"] * 60)
    texts = [wrapped, grant, inside, repeated, f"{prose(rng, 300)}\n{licences.BODIES['GPL-3.0-text']}", prose(rng, 300)]
    got = {(r.doc_id, r.notice): r for r in licences.scan(frame(spark, texts)).collect()}
    found = {(0, "GPL-notice"), (1, "MIT-grant"), (2, "Apache-2.0"), (3, "proprietary"), (4, "GPL-3.0-text")}
    assert found <= set(got) and 5 not in {d for d, _ in got}
    assert got[2, "Apache-2.0"].line == "licensed under the apache license version 2 0" and got[2, "Apache-2.0"].dice == 1


def test_licence_windows_match_brute_force(spark):
    rng = np.random.default_rng(13)
    listed = {f"n{n}": prose(rng, n, 30) for n in (2, 5, 9, 30)}
    texts = []
    for body in listed.values():
        for edits in (0, 1, 2, 3):
            texts.append(f"{prose(rng, 25, 30)} {edited(rng, body, edits)} {prose(rng, 20, 30)}")
    texts += [" ".join(listed["n30"].split()[:25]), " ".join(listed["n30"].split()[5:]), f"{prose(rng, 9, 30)} {listed['n5']}"]
    pairs = lambda w: set(zip(w, w[1:]))
    expected = {}
    for i, text in enumerate(texts):
        words = text.split()
        for name, body in listed.items():
            own, n = pairs(body.split()), len(body.split())
            held = [pairs(words[a : a + n]) for a in range(len(words))] + [pairs(words)]
            best = max(2 * len(x & own) / (len(x) + len(own)) for x in held)
            if best >= 0.8:
                expected[i, name] = best
    got = {(r.doc_id, r.notice): r.dice for r in licences.scan(frame(spark, texts), listed=listed).collect()}
    assert got == pytest.approx(expected) and len(expected) > 10


def page_text(html):
    blocks = html_blocks.blocks_of(html)
    return html_blocks.text_under(blocks, html_blocks.best_first(html_blocks.container_scores(blocks))).split("\n")


def test_headlines_and_leads_beside_the_winner_are_kept():
    a, b, lead = "first part " * 36, "second part " * 33, "intro " * 33
    nav = "<div class=links><a href=a>one link</a> <a href=b>another one</a></div>" * 20
    inner = f"<h1>Title</h1><p>{lead}</p><section>{a}</section><section>{b}</section>"
    want = ["Title", lead.strip(), a.strip(), b.strip()]
    assert page_text(f"<body>{nav}<article>{inner}</article></body>") == want
    assert page_text(f"<body>{nav}<div id=x><h1><a href=c>Title</a></h1><p>{lead}</p><div class=entry-content>{a}</div></div></body>") == want[:3]
    cells = f"<table><tr><td>{a}</td><td>{b}</td></tr></table>"
    assert page_text(f"<body>{nav}<article><p>{lead}</p>{cells}</article></body>") == want[1:]


def test_junk_named_wrappers_of_the_page_are_read():
    a, other = "long text " * 40, "remark " * 80
    for name in ("no-sidebar", "with-sidebar", "page comments-open"):
        html = f"<body><div class='{name}'><article><h1>T</h1><p>{a}</p></article><div class=sidebar>{other}</div></div></body>"
        assert page_text(html) == ["T", a.strip()]
    assert page_text(f"<body><article><p>{a}</p></article><div class=comments>{other}</div></body>") == [a.strip()]


def test_extraction_is_widened_as_the_host_or_the_page_shows(spark):
    a, b = "first part " * 30, "second part " * 30
    page = "<html><body><article><h1>Title</h1><p>lead %d</p><section>%s</section><section>%s</section></article></body></html>"
    post = "<html><body><div class=wrap><div class=post><p>" + a + "</p></div></div></body></html>"
    odd = "<html><body><div class=wrap><div class=post><p>ok</p></div><div class=box><p>longer, on this page only</p></div></div></body></html>"
    pages = [(i, "http://a.example/", page % (i, a, b)) for i in range(3)]
    pages += [(i, "http://b.example/", post) for i in range(3, 9)] + [(9, "http://b.example/", odd)]
    got = {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Title\nlead {i}\n{a.strip()}\n{b.strip()}" for i in range(3))
    assert got[3] == a.strip() and got[9] == "ok"


def test_windows_with_parts_in_another_order(spark):
    rng = np.random.default_rng(14)
    item = prose(rng, 60, 30_000).split()
    swapped = item[30:] + item[:30]
    texts = [" ".join(prose(rng, 80, 30_000).split() + swapped + prose(rng, 70, 30_000).split()), prose(rng, 200, 30_000)]
    apart = prose(rng, 300, 30_000).split()
    texts.append(" ".join(item[:30] + apart + item[30:]))  # both halves, but not in one window
    bench = spark.createDataFrame([(0, " ".join(item))], "item_id long, text string")
    got = [(r.doc_id, r.start, round(r.similarity, 2)) for r in decontaminate.report(frame(spark, texts), bench).collect()]
    assert [(d, s) for d, s, _ in got] == [(0, 80)] and got[0][2] >= 0.8


def test_licence_sql_takes_lines_of_any_length():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents AS SELECT 1 AS doc_id, ? AS text", [" ".join(["all rights reserved"] * 300)])
    assert [r[:2] for r in connection.execute(licences.scan_sql()).fetchall()] == [(1, "proprietary")]
