"""Operators 11, 12 and 13 against brute force, and their defined results on odd rows."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
import zstandard
from pyspark.sql import functions as F

from lakeload.llm import collocations, lexical_search, url_rules


# --- operator 11

def brute_collocations(rows, support, longest, top, absorb=100):
    """[(lang, rank, phrase, a, l, r, n, score)] of (text, lang) rows."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = tuple(w for w in re.split("[ \t]", piece) if w)
            n[lang or "und"] += len(words)
            for k in range(1, longest + 1):
                f.update((lang or "und", words[i:i + k]) for i in range(len(words) - k + 1))
    found = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= support}
    out = defaultdict(list)
    for (lang, p), a in found.items():
        def holds(q):
            return len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))
        if any(g == lang and holds(q) and 100 * b >= absorb * a for (g, q), b in found.items()):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n[lang], -s)
                  for lang, own in out.items() for i, (s, a, p, left, right) in enumerate(sorted(own)[:top]))


def phrase_rows(seed, docs=120):
    rng = random.Random(seed)
    fixed = ["The big red Fox", "a big red fox", "new york city hall", "né à Paris, né à paris", "tick tick tick tick tick tick"]
    rows = []
    for _ in range(docs):
        parts = [rng.choice(fixed) if rng.random() < 0.4 else rng.choice("alpha beta gamma delta".split()) for _ in range(rng.randrange(40))]
        rows.append((rng.choice([" ", "\t", "  "]).join(parts) + rng.choice([".", "! ", "\n", ""]) + " ".join(parts[:9]), rng.choice(["en", "de", None, "und"])))
    return rows + [(None, "en"), ("", None), (" \t.,\n", "fr")] + rows[:3] * 5


@pytest.mark.parametrize("support,longest,top,shard,words,bits", [(5, 5, 2000, 900, 400, 1 << 16), (12, 3, 4, 10 ** 9, 1 << 20, 1 << 20),
                                                                    (3, 4, 50, 1, 100, 64), (8, 5, 30, 4000, 3000, 1 << 10), (5, 1, 5, 50, 9, 64)])
def test_collocations_equal_brute_force(spark, support, longest, top, shard, words, bits):
    rows = phrase_rows(support)
    df = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    got = collocations.collocations(df, support, longest, top, shard_bytes=shard, range_words=words, bits=bits).collect()
    assert sorted(tuple(r) for r in got) == brute_collocations(rows, support, longest, top)


def test_absorbing_at_a_smaller_share(spark):
    rows = phrase_rows(3)
    df = spark.createDataFrame(rows, "text string, lang string")
    got = collocations.collocations(df, 4, 5, 2000, absorb=60, shard_bytes=2500).collect()
    assert sorted(tuple(r) for r in got) == brute_collocations(rows, 4, 5, 2000, absorb=60)


def test_products_beyond_64_bits_are_exact(spark):
    a, n, left, right = 123456789012345, 7000000000001, 90000000007, 80000000011
    df = spark.sql(f"SELECT {a}L AS a, {n}L AS n, {left}L AS l, {right}L AS r")
    assert df.select(collocations.score_of("a", "n", "l", "r").alias("x")).first().x == 1000 * a * n // (left * right)


def test_local_supports_cover_the_global_one():
    rng = random.Random(1)
    for _ in range(200):
        sizes = [rng.randrange(1, 1000) for _ in range(rng.randrange(1, 30))]
        locals_ = [collocations.local_support(100, s, sum(sizes)) for s in sizes]
        assert sum(x - 1 for x in locals_) < 100      # just below everywhere is below the support


def test_what_shards_leave_unsaid_is_bounded():
    """A phrase is out only if its counts, with all that silent shards may hold, stay below the support."""
    rng = np.random.default_rng(4)
    for _ in range(50):
        counts = rng.integers(0, 9, (30, int(rng.integers(1, 8))))
        least = rng.integers(1, 6, counts.shape[1])
        squeeze = zstandard.ZstdCompressor().compress
        rows = []
        for s in range(len(least)):
            own = [h for h in range(30) if counts[h, s] >= least[s]]
            sent = np.array([(h, 7, counts[h, s] - least[s] + 1) for h in own], collocations.SENT)
            rows.append(("en", 3, sent.tobytes(), squeeze(b"\n".join(b"p%d" % h for h in own)), int((least - 1).sum())))
        pdf = pd.DataFrame([r for r in rows if r[2]], columns=["lang", "range", "sent", "names", "everywhere"])
        most = np.where(counts >= least, counts, least - 1).sum(axis=1)
        want = [h for h in range(30) if most[h] >= 20 and (counts[h] >= least).any()]
        if len(pdf):
            left = collocations.possible(20)(pdf)
            assert len(left) == bool(want)
            if want:
                assert np.frombuffer(left["keys"][0], collocations.KEY)["hash"].tolist() == want
                assert zstandard.ZstdDecompressor().decompress(left["names"][0]).split(b"\n") == [b"p%d" % h for h in want]


def test_collocations_on_odd_rows(spark, messy, nothing):
    rows = [(r.text, r.lang) for r in messy.collect()]
    got = collocations.collocations(messy, 4, 5, 20).collect()
    assert sorted(tuple(r) for r in got) == brute_collocations(rows, 4, 5, 20)
    assert collocations.collocations(nothing).count() == 0


# --- operator 12

def terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute_search(docs, items, top=20):
    """Sorted [(item_id, rank, doc_id, score)] of (doc_id, text) rows and (item_id, text) rows."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, length = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        found = []
        for i, b in bags:
            m = 75 + 25 * sum(b.values()) * n_docs // length
            score = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * b[t] // (1000 * b[t] + 12 * m))
                        for t, q in Counter(terms(text)).items() if b[t])
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=repr)


def search_rows(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)] + ["Größe", "ÉTÉ", "x1y", "日本"]
    text = lambda n: rng.choice([" ", "-", ". "]).join(rng.choice(vocabulary) for _ in range(rng.randrange(n)))
    docs = [(i, text(60)) for i in range(150)]
    docs += [(1000 + i, docs[3][1]) for i in range(60)] + [(5, "w1 w2"), (5, "w1 w2"), (None, "w1 w1 W1"), (None, "w1 w1 W1"), (7, None), (8, " ;, ")]
    docs += [(2000 + i, "w3 filler" + str(i)) for i in range(40)]           # one class: equal tf and equal m
    items = [(i, text(12)) for i in range(25)] + [(3, "w1 w1 w2"), (None, "w3"), (50, None), (51, "unheard"), (52, docs[3][1])]
    rng.shuffle(docs)
    return docs, items


@pytest.mark.parametrize("block,top", [(1 << 18, 20), (20, 20), (40, 3)])
def test_search_equals_brute_force(spark, block, top):
    docs, items = search_rows(block)
    got = lexical_search.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
                                spark.createDataFrame(items, "item_id long, text string"), top, block).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_search(docs, items, top)


def test_a_class_is_scored_once_and_expanded_by_id(spark):
    docs = spark.createDataFrame([(i, "rare word") for i in range(500, 0, -1)] + [(i, f"other{i} text{i}") for i in range(501, 1500)], "doc_id long, text string")
    rows = lexical_search.bags(docs, [b"rare"])
    kept = lexical_search.members(rows, F.lit(100), 20).collect()
    assert len({r["class"] for r in kept}) == 1 and sorted(r.doc_id for r in kept) == list(range(1, 21))
    got = lexical_search.search(docs, spark.createDataFrame([(1, "rare")], "item_id long, text string")).collect()
    assert [(r.rank, r.doc_id) for r in sorted(got, key=lambda r: r["rank"])] == [(i, i) for i in range(1, 21)]


@pytest.mark.parametrize("most", [1, 1 << 60])
def test_sums_in_floats_and_integers_agree(most):
    rng = np.random.default_rng(2)
    at, item = rng.integers(0, 50, 400), rng.integers(0, 9, 400)
    postings = lexical_search.Postings(50, at, item, rng.integers(1, 20_000, 400))
    postings.most = most
    m, of, term, tf = rng.integers(75, 200, 30), rng.integers(0, 30, 500), rng.integers(0, 50, 500), rng.integers(1, 9, 500)
    want = np.zeros((30, postings.items), np.int64)
    for o, t, c in zip(of, term, tf):
        for a, b in zip(postings.item[postings.starts[t]:postings.starts[t + 1]], postings.weight[postings.starts[t]:postings.starts[t + 1]]):
            want[o, a] += b * (10 ** 9 * c // (1000 * c + 12 * m[o]))
    assert (postings.scores(m, of, term, tf) == want).all()


def test_search_on_odd_rows(spark, messy, nothing):
    items = [(1, "alpha1 beta2 words here a b c"), (2, None), (3, "MIT license")]
    asked = spark.createDataFrame([(i, t, "junk") for i, t in items], "item_id long, text string, doc_id string")
    got = lexical_search.search(messy, asked).collect()
    want = brute_search([(r.doc_id, r.text) for r in messy.collect()], items)
    assert sorted((tuple(r) for r in got), key=repr) == want
    assert lexical_search.search(nothing, asked).count() == 0
    assert lexical_search.search(messy, asked.where("item_id < 0")).count() == 0


# --- operator 13

URLS = [None, "", "no scheme", "http://", "https://x.net", "http://x.net/", "http://NET/a", "http://planet/a", "ftp://a.b.net/en/x?q#f",
        "http://example.net/en/", "http://example.net/EN/", "http://sub.EXAMPLE.net/en/1", "http://notexample.net/en/", "http://example.com/de/x",
        "http://www.example.com/de", "http://org/fr/", "http://a.org/fr/x", "http://a.org/france", "http://a.org?x/fr/", "x://y://z.org/fr/",
        "http://a.com/login", "http://a.com/LOGIN?x=1", "http://a.com/loginx", "http://en.wikipedia.org/login", "http://fakewikipedia.org/login",
        "http://a.com/list?page=2&ref=x", "http://a.com/list?page=2&x=ref", "http://casino", "http://my-casino.com/", "http://casinos.com/",
        "http://a.com/f.exe", "http://a.com/f.exec", "http://a.com/x?PHPSESSID=1#y", "http://a.com/\nlogin\n/x", "http://user@example.net/en/a",
        "http://example.net:80/en/", "http://ünï.org/fr/ü", "://net/", "http://www.example.org/wp-login.php", "http://a.com/?s=q"]


def brute_verdict(url, rules):
    host, tail = url_rules.address_of(url)
    lower = (host + tail).translate(url_rules.LOWER)
    fit = [r for r in rules if re.search(r.regex, host + tail if r.site else lower)]
    sites = sorted((r for r in fit if r.site), key=lambda r: -len(r.site))
    if sites:
        return sites[0].site, sites[0].verdict
    return None, "block" if any(r.verdict == "block" for r in fit) and all(r.verdict == "block" for r in fit) else "allow"


def test_urls_equal_a_scan_of_all_rules(spark, nothing):
    rules = url_rules.site_rules() + url_rules.pattern_rules()
    df = spark.createDataFrame([(i % 7 or None, u, "junk") for i, u in enumerate(URLS * 2)], "page_id long, url string, rule string")
    got = url_rules.filter_urls(df.repartition(3)).collect()
    want = sorted(((i % 7 or None, u, *brute_verdict(u, rules)) for i, u in enumerate(URLS * 2)), key=repr)
    assert sorted(((r.page_id, r.url, r.rule, r.verdict) for r in got), key=repr) == want
    assert url_rules.filter_urls(df.limit(0)).count() == 0


@pytest.mark.parametrize("url,host,path,rule,verdict", [
    ("http://x.net", "x.net", "", None, "allow"), ("http://x.net/", "x.net", "/", "net/", "block"), ("HTTP://Sub.Example.NET/en/1?q", "sub.example.net", "/en/1", "example.net/en/", "allow"),
    ("http://example.net/EN/", "example.net", "/EN/", "net/", "block"), ("http://notexample.net/en/", "notexample.net", "/en/", "net/", "block"),
    ("http://planet/a", "planet", "/a", None, "allow"), ("http://example.com/de", "example.com", "/de", None, "allow"), (None, "", "", None, "allow"),
    ("http://a.org?x/fr/", "a.org", "", None, "allow"), ("x://y://z.org/fr/", "y:", "//z.org/fr/", None, "allow"), ("mailto:x", "", "", None, "allow")])
def test_site_rules_by_hand(url, host, path, rule, verdict):
    rules = url_rules.site_rules()
    index = url_rules.RuleIndex(rules, {})
    assert url_rules.judged(index, url)[:4] == (host, path, rule, verdict)


def test_rules_are_filed_under_their_rarest_token(spark):
    rules = [url_rules.Rule(p, "block") for p in ("/common/rare^", "^common^", "*free*", "a*b", "||shop.example/x", "?id=")]
    assert [r.tokens for r in rules] == [["common", "rare"], ["common"], [], [], ["example", "shop"], ["id"]]
    df = spark.createDataFrame([(i, f"http://h{i}.com/common/{i}") for i in range(50)] + [(99, "http://h.com/rare/common/rare/")], "page_id long, url string")
    counts = url_rules.token_counts(df, {t for r in rules for t in r.tokens})
    assert counts == {"common": 51, "rare": 1}
    index = url_rules.RuleIndex(rules, counts)
    assert dict(index.by_token) == {"rare": [0], "common": [1], "example": [4], "id": [5]} and index.always == [2, 3]
    assert index.candidates({"common", "x"}) == [2, 3, 1]


@pytest.mark.parametrize("seed", range(20))
def test_no_rule_that_fits_is_missed_by_the_index(seed):
    rng = random.Random(seed)
    piece = lambda: rng.choice(["a", "ab", "b", "1", "/", ".", "?", "^", "*", "-", "=", "É"])
    rules = [url_rules.Rule(rng.choice(["", "", "||"]) + "".join(piece() for _ in range(rng.randrange(1, 7))), "block") for _ in range(60)]
    index = url_rules.RuleIndex(rules, {})
    for _ in range(300):
        url = "h://" + "".join(rng.choice(["a", "ab", "b", "1", "/", ".", "?", "-", "=", "É", "A"]) for _ in range(rng.randrange(12)))
        host, tail = url_rules.address_of(url)
        lower = (host + tail).translate(url_rules.LOWER)
        assert {r.pattern for r in index.fitting(host, tail)} == {r.pattern for r in rules if re.search(r.regex, lower)}


def test_rules_must_be_bounded_and_have_a_verdict(spark, monkeypatch):
    monkeypatch.setattr(url_rules, "MOST_BYTES", 10)
    with pytest.raises(ValueError):
        url_rules.filter_urls(spark.createDataFrame([(1, "u")], "page_id long, url string"))
    with pytest.raises(ValueError):
        url_rules.Rule("x", "maybe")
