"""Host trust (2), language ID (4), n-gram ratio rules (6), quality classifier (9) and the bucket sketch."""

import math
import random
import re
import struct
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
import zstandard
from helpers import EXTRA, WORD, edge_rows, prose, table

from qualia.llm import host_trust, ngram_ratio, ordinal_quality, zstd_language
from qualia.llm.batches import hashed_words, slices
from qualia.llm.queries import URL_RULES, grades, op4_zstd_language
from qualia.llm.sketch import bucket_counts


def test_bucket_counts_cover_every_row(spark):
    df = spark.range(0, 5000, 1, 7)
    found = bucket_counts(df, lambda b: b.column("id").to_numpy() % 37, bits=15)
    assert found[:37].sum() == 5000 == found.sum() and set(found[:37]) == {135, 136}
    assert bucket_counts(df.where("id < 0"), lambda b: b.column("id").to_numpy(), bits=4).sum() == 0


def test_counting_may_cut_batches_smaller(spark):
    df = spark.range(0, 5000, 1, 2).selectExpr("repeat('x', 100) AS text")
    plain = bucket_counts(df, lambda b: np.full(b.num_rows, b.num_rows <= 10, np.int64), bits=1)
    cut = bucket_counts(df, lambda b: np.full(b.num_rows, b.num_rows <= 10, np.int64), bits=1,
                        split=lambda batches: slices(batches, max_bytes=1000))
    assert plain.tolist() == [5000, 0] and cut.tolist() == [0, 5000]


def test_features_are_made_of_small_slices():
    texts = pa.RecordBatch.from_pydict({"text": ["good words here " * 4000] * 100 + [None]})
    sizes = [b.column("text").nbytes for b in slices([texts], max_bytes=ordinal_quality.SLICE)]
    assert max(sizes) < 1.2 * 2**20 and sum(len(x) for x in slices([texts], max_bytes=ordinal_quality.SLICE)) == 101


def test_compressors_of_a_level_are_made_when_needed():
    ours = zstd_language.Compressors({"a": b"one two three " * 20, "b": b"eins zwei drei " * 20})
    assert ours.predict("one two three one two")[0] == "a" and list(ours.by_level) == [zstd_language.LEVELS[0]]
    ours.predict("§ä§")
    assert len(ours.by_level) > 1


def test_word_hashes_follow_words():
    texts = [t for _, t in edge_rows()] + ["x" * 500 + " " + "x" * 499, "A a", "tab\tA", "eightchr eightchrs"]
    hashes, bounds = hashed_words(pa.array(texts, pa.string()))
    by_word = {}
    for text, a, b in zip(texts, bounds[:-1], bounds[1:]):
        words = [w.encode().lower() for w in WORD.findall(text or "")]
        assert len(words) == b - a
        for w, h in zip(words, hashes[a:b].tolist()):
            assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)


# --- host trust


def brute_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def brute_rule(host, path, rules):
    best = None
    for verdict, text in rules:
        own, rest = text.split("/", 1)
        if (host == own or host.endswith("." + own)) and path.startswith("/" + rest) and (best is None or len(text) > len(best[1])):
            best = (verdict, text)
    return best


def brute_rank(edges, seeds, steps=10, d=0.85):
    total = sum(seeds.values())
    start = {h: n / total for h, n in seeds.items() if n} if total else {}
    out = Counter()
    for (a, _), n in edges.items():
        out[a] += n
    rank = dict(start)
    for _ in range(steps):
        new = defaultdict(float)
        for h, v in start.items():
            new[h] += (1 - d) * v
        for (a, b), n in edges.items():
            new[b] += d * n / out[a] * rank.get(a, 0.0)
        rank = new
    mass = sum(rank.values()) or 1.0
    return {h: v / mass for h, v in rank.items()}


PAGES = [
    (1, "http://A.org/x?q=/y", '<a href="http://b.net/1">b</a> <a href="/local">'),
    (2, "https://www.example.org/es/1#f", "<a href='//spam.net/a'></a><img src=\"https://b.net:80/i\">"),
    (3, "http://b.net", '<a href="http://c.net/">c</a><a href="http://c.net/">again</a>'),
    (4, "http://c.net/p", None), (5, None, "x"), (6, "no scheme", '<a href="http://a.org/">'), (7, "http://x.com/de/1", ""),
    (8, "http://farm.net/q", '<a href="http://x.com/">x</a><a href="http://www.example.org/">e</a>'),
    (9, "http://org/", ""), (10, "http://x.com/fr/1", ""), (11, "ftp://É.com/fr/", ""), (12, "http:///p", ""),
    (13, "http://example.org/en/17", ""), (13, "http://example.org/en/17", ""), (14, "http://notexample.org/en/1", ""),
    (15, "http://farm.net/q", '<a href="http://user@x.com:8080/">x</a>'), (16, "http://alone.net/?a", ""), (17, "a.org\nhttp://a.org/", ""),
]


def test_urls_match_brute_force(spark):
    schema = "page_id long, url string, html string, host string, rule string, trust string"
    df = spark.createDataFrame([(*p, "clash", "clash", "clash") for p in PAGES], schema)
    found = host_trust.judge_urls(df, URL_RULES).collect()
    edges, allowed, blocked = Counter(), Counter(), Counter()
    for _, url, html in PAGES:
        host, path = brute_url(url)
        rule = brute_rule(host, path, URL_RULES)
        if host and rule:
            (allowed if rule[0] == "allow" else blocked)[host] += 1
        to = {m.split("@")[-1].split(":")[0] for m in re.findall(host_trust.LINK, html or "")}
        for other in {m for m in re.findall(host_trust.LINK, html or "")}:
            target = other.split("@")[-1].split(":")[0]
            if host and target != host:
                edges[host, target] += 1
        assert len(to) >= 0
    trust = brute_rank(edges, allowed)
    distrust = brute_rank(Counter({(b, a): n for (a, b), n in edges.items()}), blocked)
    expected = Counter()
    for i, url, _ in PAGES:
        host, path = brute_url(url)
        rule = brute_rule(host, path, URL_RULES)
        t, s = trust.get(host, 0.0), distrust.get(host, 0.0)
        expected[i, host, path, rule and rule[1], rule[0] if rule else "allow" if t >= s else "block", round(t, 9), round(s, 9)] += 1
    assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict, round(r.trust, 9), round(r.distrust, 9)) for r in found) == expected
    verdict = {r.page_id: r.verdict for r in found}
    assert verdict[4] == "allow" and verdict[8] == "block"  # trusted through a chain; links to blocked hosts
    assert host_trust.judge_urls(df.where("page_id < 0"), URL_RULES).count() == 0


def test_trust_converges_on_long_chains_and_cycles(spark):
    pages = [(0, "http://x.com/de/0", '<a href="http://c0.net/">')] + [
        (i + 1, f"http://c{i}.net/", f'<a href="http://c{i + 1}.net/"> <a href="http://r{i % 3}.net/">') for i in range(16)]
    pages += [(30 + i, f"http://r{i}.net/", f'<a href="http://r{(i + 1) % 3}.net/">') for i in range(3)]
    pages += [(40, "http://c16.net/", '<a href="http://x.com/">'), (41, "http://x.com/fr/1", "")]
    found = {r.host: r for r in host_trust.judge_urls(spark.createDataFrame(pages, "page_id long, url string, html string"), URL_RULES).collect()}
    edges = Counter()
    for _, url, html in pages:
        for to in set(re.findall(host_trust.LINK, html)):
            edges[brute_url(url)[0], to] += 1
    trust = brute_rank(edges, {"x.com": 1}, steps=600)
    distrust = brute_rank(Counter({(b, a): n for (a, b), n in edges.items()}), {"x.com": 1}, steps=600)
    for host, row in found.items():
        assert row.trust == pytest.approx(trust.get(host, 0.0), abs=1e-8) and row.distrust == pytest.approx(distrust.get(host, 0.0), abs=1e-8)
    assert found["c2.net"].distrust > 0 and found["c14.net"].trust > 0  # 15 links from the seed, either way


def test_ports_do_not_split_a_host(spark):
    pages = [(1, "http://x.com/fr/1", '<a href="http://shop.net:8080/">'), (2, "http://shop.net:8080/a", '<a href="http://u@shop.net:8080/b">'),
             (3, "http://shop.net/", '<a href="http://x.com/">'), (4, "http://x.com/de/1", "")]
    found = {r.page_id: r for r in host_trust.judge_urls(spark.createDataFrame(pages, "page_id long, url string, html string"), URL_RULES).collect()}
    assert found[2].host == "shop.net:8080" and found[2].trust == found[3].trust > 0 and found[2].distrust == found[3].distrust > 0


# --- language


def language_rows(rng, n):
    syllables = {"aa": ["ka", "lo", "mi"], "bb": ["straß", "und", "ich"], "cc": ["eau", "que", "ç"]}
    out = []
    for i in range(n):
        lang = rng.choice(list(syllables))
        out.append((i, " ".join("".join(rng.choices(syllables[lang], k=2)) for _ in range(rng.randrange(5, 60))), lang))
    return out


def test_language_is_learned_and_predicted(spark, tmp_path):
    rng = random.Random(1)
    rows = language_rows(rng, 300)
    df = spark.createDataFrame(rows + [(900, "x", None)], "doc_id long, text string, lang string")
    model = zstd_language.learn_dictionaries(df.where("doc_id < 150 or doc_id = 900"), sample_rows=20)
    assert sorted(model) == ["aa", "bb", "cc"]
    found = {r.doc_id: r for r in zstd_language.predict(df.where("doc_id between 150 and 299"), model).collect()}
    right = sum(found[i].lang_pred == lang for i, _, lang in rows[150:])
    assert right >= 0.97 * 150 and all(0 <= r.score <= 1 for r in found.values())


def test_narrow_margins_are_rejected(spark):
    rng = random.Random(3)
    rows = language_rows(rng, 1500)
    model = zstd_language.learn_dictionaries(spark.createDataFrame(rows[:1200], "doc_id long, text string, lang string"), sample_rows=60)
    assert model.margin > 0.02
    clean = [(i, t) for i, t, _ in rows[1200:]]
    noise = [(i, " ".join("".join(rng.choices("bdfgjpqvwxyz", k=4)) for _ in range(rng.choice([60, 2000])))) for i in range(2000, 2040)]
    unlearned = [(i, " ".join("".join(rng.choices(["zu", "py", "vox"], k=2)) for _ in range(80))) for i in range(3000, 3040)]
    half = {c: " ".join("".join(rng.choices(s, k=2)) for _ in range(60)) for c, s in (("a", ["ka", "lo", "mi"]), ("b", ["straß", "und", "ich"]))}
    mixed = []
    for i in range(4000, 4040):  # as many bytes of one language as of the other
        a, b = (" ".join(rng.sample(half[c].split(), 60))[:200] for c in "ab")
        mixed.append((i, a + " " + b))
    odd = spark.createDataFrame(clean + noise + unlearned + mixed, "doc_id long, text string")
    kept = {r.doc_id // 1000 for r in zstd_language.predict(odd, model).where("accepted and doc_id >= 2000").collect()}
    assert not kept & {2, 3}
    accepted = {r.doc_id for r in zstd_language.predict(odd, model).where("accepted").collect()}
    assert len([i for i, _ in clean if i in accepted]) >= 0.95 * len(clean)
    assert len([i for i, _ in mixed if i in accepted]) <= 0.1 * len(mixed)
    assert zstd_language.keep_identified(odd, model).count() == len(accepted)


def test_languages_of_copies_are_learned_in_full(spark):
    rng = random.Random(9)
    texts = {lang: [" ".join("".join(rng.choices(s, k=3)) for _ in range(20)) for _ in range(50)] for lang, s in
             (("aa", ["ka", "lo", "mi"]), ("bb", ["straß", "und", "ich"]))}
    rows = [(t, "aa") for t in texts["aa"] for _ in range(1000)] + [(t, "bb") for t in texts["bb"]]
    model = zstd_language.learn_dictionaries(spark.createDataFrame(rows, "text string, lang string"))
    for lang, own in texts.items():  # fewer texts than the sample has: all are learned, whatever their copies
        assert sorted(model[lang].decode().split("\n")) == sorted(own)


def test_every_labelled_language_is_learned(spark):
    rows = [(f"wort{i} tal{i}", f"l{i:02}") for i in range(70)]
    assert sorted(zstd_language.learn_dictionaries(spark.createDataFrame(rows, "text string, lang string"))) == [x for _, x in rows]


def test_languages_are_learned_from_all_of_a_text(spark):
    """Texts that begin alike in all languages: only what comes later tells them apart."""
    rng = random.Random(31)
    words = {lang: [f"{lang}{rng.randrange(10**6)}" for _ in range(300)] for lang in ("aa", "bb")}
    head = " ".join(f"head{rng.randrange(10**6)}" for _ in range(300))

    def tail(lang):
        return " ".join(rng.choice(words[lang]) for _ in range(900))

    rows = [(f"{head} {tail(lang)}", lang) for lang in words for _ in range(60)]
    model = zstd_language.learn_dictionaries(spark.createDataFrame(rows, "text string, lang string"), sample_rows=40)
    assert all(sum(w in content.decode() for w in words[lang]) > 200 for lang, content in model.items())
    assert model.margin > 0
    plain = zstd_language.Compressors(model)
    assert all(plain.predict(tail(lang))[0] == lang for lang in words for _ in range(20))


def test_predictions_match_plain_compression(spark):
    """The least total of compressed blocks over all dictionaries, recomputed with the library alone."""
    rng = random.Random(32)
    model = {lang: " ".join(f"{lang}{rng.randrange(400)}" for _ in range(800)).encode() for lang in ("cc", "aa", "bb")}
    texts = [" ".join(f"{rng.choice(['aa', 'bb', 'cc'])}{rng.randrange(400)}" for _ in range(n)) for n in (1, 3, 40, 700, 3000)]

    def size(text, lang):
        params = zstandard.ZstdCompressionParameters.from_level(6, write_content_size=0, write_checksum=0, write_dict_id=0)
        used = zstandard.ZstdCompressionDict(model[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        raw = text.lower().encode()
        return sum(len(zstandard.ZstdCompressor(dict_data=used, compression_params=params).compress(raw[i:i + 1500]))
                   for i in range(0, len(raw), 1500))

    found = {r.doc_id: r for r in zstd_language.predict(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()}
    for i, text in enumerate(texts):
        sizes = sorted((size(text, lang), lang) for lang in model)
        if sizes[0][0] < sizes[1][0]:
            assert found[i].lang_pred == sizes[0][1]
            assert found[i].saved_bytes == sizes[1][0] - sizes[0][0]
            assert found[i].score == pytest.approx(1 - sizes[0][0] / sizes[1][0])
    assert sum(r.saved_bytes > 0 for r in found.values()) >= 3  # short texts may tie


def test_language_query_defines_documents_without_id(spark, tmp_path):
    rows = [(i, f"{'uno dos tres' if i % 2 else 'one two three'} {i}", "es" if i % 2 else "en", "s") for i in range(40)]
    rows += [(None, "only here a language of its own", "xx", "s")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    found = op4_zstd_language(spark, str(tmp_path)).collect()
    assert len(found) == 41 and {r.held_out for r in found} == {True, False}
    assert [r.held_out for r in found if r.doc_id is None] == [False]
    assert "xx" not in {r.lang_pred for r in found}


def test_language_edge_cases(spark, tmp_path):
    rows = edge_rows()
    docs = table(spark, tmp_path, rows)
    model = {"aa": b"two words one no id", "bb": b"xyz xyz"}
    found = zstd_language.predict(docs, model).collect()
    assert len(found) == len(rows)
    text = defaultdict(list)
    for i, t in rows:
        text[i].append(t)
    for r in found:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for t in text[r.doc_id][:1] for c in t or ""))
        assert r.accepted == (r.lang_pred != "und" and r.saved_bytes >= 1)
    kept = zstd_language.keep_identified(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.accepted for r in found)
    assert {r.lang_pred for r in zstd_language.predict(docs, {}).collect()} == {"und"}
    empty = table(spark, tmp_path, [], "empty")
    assert zstd_language.learn_dictionaries(empty.where("false")) == {}
    assert zstd_language.predict(empty, model).count() == 0


# --- n-gram ratio rules


def brute_base(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    count, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            covered.update(range(i, i + 8))
    n, r = len(words), len(covered)
    return n, sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), r, n < 20 or 100 * r > 30 * n


def test_base_rules_match_brute_force(spark, tmp_path):
    rng = random.Random(3)
    unit = "a b c d e f g h i"
    rows = edge_rows() + [
        (200, " ".join(["z"] * 50)), (201, f"{unit} {unit}"), (202, f"{unit} x {unit} y {unit} " + prose(rng, 60)),
        (203, "same line\nsame line\nsame line \n\n" + prose(rng, 30)), (204, "a\x1cb a\xa0b " * 15),
        *[(300 + i, " ".join(rng.choice("abc") for _ in range(rng.randrange(60)))) for i in range(60)],
    ]
    docs = table(spark, tmp_path, rows)
    trusted = spark.createDataFrame([(202,), (None,), (202,)], "id long")
    found = ngram_ratio.judge(docs, trusted, bits=10).collect()
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found)
    assert got == Counter((i, *brute_base(t)) for i, t in rows)
    assert not any(r.kept for r in found if r.base_failed)


def test_scores_tell_trusted_prose_from_junk(spark, tmp_path):
    rng = random.Random(4)
    good = [(i, " ".join(f"g{rng.randrange(50)}" for _ in range(40))) for i in range(60)]
    junk = [(100 + i, " ".join(f"j{rng.randrange(50)}" for _ in range(40))) for i in range(60)]
    docs = table(spark, tmp_path, good + junk + [(500, good[0][1]), (None, good[0][1])])
    trusted = spark.createDataFrame([(i,) for i in range(0, 60, 2)], "id long")
    found = ngram_ratio.judge(docs, trusted, bits=12)
    rows = {r.doc_id: r for r in found.collect()}
    assert all(rows[i].kept for i, _ in good) and not any(rows[i].kept for i, _ in junk)
    assert rows[500].score == rows[0].score == rows[None].score
    again = {r.doc_id: r.score for r in ngram_ratio.judge(docs.repartition(5), trusted, bits=12).collect()}
    assert again == {i: r.score for i, r in rows.items()}
    plain = ngram_ratio.judge(docs, trusted.where("false"), bits=12).collect()
    assert all(r.score == 0 and r.kept == (not r.base_failed) for r in plain)
    assert ngram_ratio.judge(table(spark, tmp_path, [], "empty"), trusted, bits=12).count() == 0


def brute_scores(rows, trusted, bits):
    """Scores in units of 2**-20 and the threshold, in plain Python."""

    def signed(h):
        return struct.pack("<Q", h)

    def buckets(text):
        words = [xxhash.xxh64_intdigest(w.encode(), 42) for w in WORD.findall(text or "")]
        pairs = [xxhash.xxh64_intdigest(signed(b), xxhash.xxh64_intdigest(signed(a), 42)) for a, b in zip(words, words[1:])]
        return [h >> (64 - bits) for h in words + pairs]

    def half(i):
        h = xxhash.xxh64_intdigest(b"half", xxhash.xxh64_intdigest(struct.pack("<q", i), 42))
        return (h - (1 << 64) if h >> 63 else h) % 2

    raw = Counter(b for _, t in rows for b in buckets(t))
    halves = [Counter(b for i, t in rows if i in trusted and half(i) == k for b in buckets(t)) for k in (0, 1)]

    def weights(target):
        n_raw, n_target, cells = sum(raw.values()), sum(target.values()), 1 << bits
        return {b: round((math.log(target[b] + 1) - math.log(n_target + cells) - math.log(n + 1) + math.log(n_raw + cells)) * 2**20)
                if n_target else 0 for b, n in raw.items()}

    def mean(weight, text):
        found = buckets(text)
        return sum(weight[b] for b in found) / len(found) if found else 0.0

    whole, other = weights(halves[0] + halves[1]), [weights(halves[1]), weights(halves[0])]
    steps = sorted(math.floor(mean(other[half(i)], t) * 1000 / 2**20) for i, t in rows if i in trusted and buckets(t))
    quantile = lambda q: steps[max(0, math.ceil(q * len(steps)) - 1)] / 1000
    return [mean(whole, t) / 2**20 for _, t in rows], quantile(0.05) - 2.0 * (quantile(0.5) - quantile(0.05))


def test_scores_and_threshold_match_brute_force(spark, tmp_path):
    rng = random.Random(9)
    rows = edge_rows() + [(400 + i, " ".join(f"{rng.choice('gh')}{rng.randrange(60)}" for _ in range(rng.randrange(1, 80)))) for i in range(120)]
    trusted = {i for i, _ in rows if i is not None and i % 3 == 0}
    ids = spark.createDataFrame([(i,) for i in trusted] + [(None,), (99999,)], "id long")
    scores, threshold = brute_scores(rows, trusted, 9)
    for filter_bits in (6, 22):  # a full bitmap changes nothing
        found = ngram_ratio.judge(table(spark, tmp_path, rows, f"docs{filter_bits}"), ids, bits=9, filter_bits=filter_bits).collect()
        assert found[0].threshold == pytest.approx(threshold, abs=1e-12) and len({r.threshold for r in found}) == 1
        got = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.score) for r in found)
        want = sorted((i is None, i or 0, len(WORD.findall(t or "")), s) for (i, t), s in zip(rows, scores))
        assert [g[:3] for g in got] == [w[:3] for w in want]
        assert [g[3] for g in got] == pytest.approx([w[3] for w in want], abs=1e-5)
        assert all(r.kept == (not r.base_failed and r.score >= r.threshold) for r in found)


def test_every_trusted_document_is_counted(spark):
    docs = spark.range(0, 20_500, 1, 4).selectExpr("id AS doc_id", "concat('a b c w', id % 7, ' x', id) AS text")
    found = ngram_ratio.judge(docs, docs.select("doc_id"), bits=12)  # the target is the whole corpus: no n-gram is told apart
    assert found.count() == 20_500 and found.where("score <> 0").count() == 0


def test_the_ratio_rules_run_no_python(spark, tmp_path):
    docs = table(spark, tmp_path, edge_rows())
    plan = ngram_ratio.judge(docs, spark.createDataFrame([(1,)], "id long"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# --- quality classifier


def rated(rng, n):
    clean = [f"c{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(clean) for _ in range(rng.randrange(20, 200))]
        grade = rng.choices([0, 1, 2], [1, 1, 4])[0]
        if grade == 1:
            words.insert(rng.randrange(len(words)), rng.choice(["vile", "nasty"]))
        if grade == 0:
            words = [w + "##" for w in words]
        rows.append((i, " ".join(words)))
        labels.append((i, grade))
    return rows, labels


def test_classifier_finds_graded_evidence(spark, tmp_path):
    rows, labels = rated(random.Random(6), 1200)
    docs = table(spark, tmp_path, rows)
    ratings = spark.createDataFrame([x for x in labels if x[0] < 800] + [(5, None), (None, 1)], "doc_id long, grade int")
    model = ordinal_quality.fit(docs, ratings, bits=14)
    assert np.all(np.diff(model.thresholds) > 0)
    found = {r.doc_id: r for r in ordinal_quality.score(docs, model).collect()}
    held = [(found[i], g) for i, g in labels if i >= 800]
    assert np.mean([r.kept for r, g in held if g == 2]) > 0.97 and np.mean([r.kept for r, g in held if g < 2]) < 0.05
    means = [np.mean([r.expected_grade for r, g in held if g == k]) for k in range(3)]
    assert means[0] < means[1] < means[2]
    assert ordinal_quality.keep_good(docs, model).count() == sum(r.kept for r in found.values())


def test_gradient_reaches_the_likelihoods_optimum():
    rng = np.random.default_rng(2)
    grades = rng.choice([0, 1, 2], 500, p=[0.2, 0.3, 0.5])
    model = ordinal_quality.fit_ordinal(np.zeros(0, int), np.zeros(0, int), grades, 4)
    tails = model.tails(np.zeros(1))[0]
    assert tails == pytest.approx([np.mean(grades > 0), np.mean(grades > 1)], abs=1e-3)


def test_classifier_edge_cases(spark, tmp_path):
    rows = edge_rows()
    docs = table(spark, tmp_path, rows)
    none = spark.createDataFrame([], "doc_id long, grade int")
    model = ordinal_quality.fit(docs, none, bits=10)
    found = ordinal_quality.score(docs, model).collect()
    assert len(found) == len(rows) and all(r.kept and r.tail_probability == 1 for r in found)
    one = ordinal_quality.fit(docs, spark.createDataFrame([(1, 2), (2, 2)], "doc_id long, grade int"), bits=10)
    assert ordinal_quality.keep_good(docs, one).columns == ["doc_id", "text", *EXTRA]
    assert ordinal_quality.score(table(spark, tmp_path, [], "empty"), model).count() == 0


def test_grades_of_labels(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 1), (3, 0, 0), (4, 0, 1), (5, None, 0), (6, 1, None)], "doc_id long, quality int, toxic int")
    assert {r.doc_id: r.grade for r in grades(labels).collect()} == {1: 2, 2: 1, 3: 0, 4: 0, 5: None, 6: None}
