"""Licence scan, host rules, URL verdicts, perspectives."""

from __future__ import annotations

import math
import random
import re

from tests.llm.cases import AWKWARD, documents
from tripmart.llm import host_rules, licenses, perspectives, url_filter


def naive_block(words, template):
    best = None
    for start in range(len(words)):
        held = len(set(words[start : start + template.span]) & set(template.words))
        if held >= template.need and words[start] in template.words and (best is None or held > best[0]):
            best = (held, start)
    return best


def test_blocks_equal_a_walk_over_all_windows():
    draw = random.Random(2)
    templates = licenses.ordered(licenses.TEMPLATES, {"the": 900, "of": 500, "license": 9}, 0.85, 1.25)
    vocabulary = sorted({w for t in templates for w in t.words})
    found = 0
    for _ in range(300):
        words = [draw.choice([*vocabulary, "x", "y"]) for _ in range(draw.randint(0, 30))]
        for t in draw.sample(templates, 3):
            at = draw.randint(0, len(words))
            text = words[:at] + draw.sample(t.words, draw.randint(t.need - 1, len(t.words))) + words[at:]
            places: dict[str, list[int]] = {}
            for i, w in enumerate(text):
                places.setdefault(w, []).append(i)
            got = licenses.best_block(places, t)
            assert got == naive_block(text, t)
            found += got is not None
    assert found > 100


def test_all_blocks_equal_a_walk_over_all_windows():
    draw = random.Random(3)
    templates = licenses.ordered(licenses.TEMPLATES, {"the": 900, "of": 500, "license": 9}, 0.85, 1.25)
    several = 0
    for _ in range(200):
        t = draw.choice(templates)
        text: list[str] = []
        for _ in range(draw.randint(1, 4)):
            text += draw.sample(t.words, draw.randint(t.need - 1, len(t.words)))
            text += [draw.choice([*t.words, "x"]) for _ in range(draw.randint(0, 40))]
        places: dict[str, list[int]] = {}
        for i, w in enumerate(text):
            places.setdefault(w, []).append(i)
        held = [(len(set(text[i : i + t.span]) & set(t.words)), i) for i in range(len(text)) if text[i] in t.words]
        got = licenses.all_blocks(places, t)
        assert got == [(n, i) for n, i in held if n >= t.need]
        several += len(got) > 1
    assert several > 50


def test_every_notice_of_a_template_has_its_block(spark):
    notice = "Released under the MIT license"
    text = " ".join([notice, *["filler"] * 50, notice, *["filler"] * 50, "licensed under cc by nc 4 0"])
    row = licenses.licence_scan(documents(spark, [(1, text, "en", "a", 0)])).first()
    full = {(b.label, b.start) for b in row.blocks if b.containment == 1}
    assert {("mit", 0), ("mit", 55), ("cc-by-nc", 110)} <= full
    assert {b.start for b in row.blocks if b.label == "mit"} == {0, 55}


def test_licences_on_awkward_rows(spark):
    docs = documents(spark)
    got = {(r.doc_id, r.labels, r.n_base) for r in licenses.licence_scan(docs).collect()}
    assert (6, "mit", 1) in got and (None, "", 0) in got
    assert licenses.licence_scan(docs).count() == len(AWKWARD)
    assert licenses.licence_scan(docs.limit(0)).count() == 0


def test_reworded_notice_is_found(spark):
    rows = [(1, "Licensed under CC BY-NC 4.0.", "en", "a", 0), (2, "licensed by the city", "en", "a", 0)]
    got = {r.doc_id: (r.labels, r.base_labels) for r in licenses.licence_scan(documents(spark, rows)).collect()}
    assert got == {1: ("cc-by-nc", ""), 2: ("", "")}


def test_hosts_of_failures_are_rejected(spark):
    fine = " ".join(f"w{i}" for i in range(60))
    rows = [(i, fine, "en", f"good{i % 8}", 0) for i in range(200)]
    rows += [(1000 + i, fine if i < 3 else "short", "en", "bad", 0) for i in range(40)]
    rows += [(2000, "short", "en", "good1", 0)]
    got = {r.doc_id: r.kept for r in host_rules.judged(documents(spark, rows)).collect()}
    assert all(got[i] for i in range(200))
    assert not any(got[1000 + i] for i in range(40)) and not got[2000]


def test_hosts_on_awkward_rows(spark):
    docs = documents(spark)
    assert host_rules.judged(docs).count() == len(AWKWARD)
    assert host_rules.judged(docs.limit(0)).count() == 0
    assert host_rules.measure("a\nb\n a\na\n\n# a b a b a") == (10, 10, 1, 1, 8)


def python_verdict(url):
    after = url.partition("://")[2] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", after)[0]
    path = re.match(r"[^?#]*", after[len(host) :])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [
        r for r in url_filter.RULES
        if (host == r.site.split("/")[0] or host.endswith("." + r.site.split("/")[0]))
        and path.startswith("/" + r.site.split("/", 1)[1])
    ]
    best = max(fits, key=lambda r: len(r.site), default=None)
    return host, path, best and best.site, best and best.verdict


URLS = [
    None, "", "nothing", "http://", "http://EXAMPLE.com", "http://example.com/en/", "http://www.example.com/en/x?y#z",
    "https://a.www.example.com/en/q", "ftp://x.net/es/1", "http://x.net/es", "http://net/fr/", "http://x.net?/fr/",
    "http://Example.COM#/en/", "a://b://c/d", "http://examplE.com/en/é?", "http://xcom/", "http://" + "a" * 5000 + ".org/1",
]


def test_rules_equal_python(spark):
    rows = [(i, u, "h", "v") for i, u in enumerate([*URLS, "http://x.com/"])]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string")
    for r in url_filter.judged(pages, trees=2).collect():
        host, path, rule, verdict = python_verdict(r.url)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
    assert url_filter.judged(pages.limit(0)).count() == 0
    only = url_filter.judged(pages.where("url like '%x.com%' or url is null")).collect()
    assert {r.verdict for r in only} == {"allow"}


def test_trees_learn_from_the_ruled_urls(spark):
    draw = random.Random(3)
    rows = []
    for i in range(400):
        spam = "/".join(str(draw.randrange(10**9)) for _ in range(4)) + "?a=1&b=2&c=3"
        plain = draw.choice(["news", "about", "team"]) + "/" + draw.choice(["today", "work"])
        host = ["x.com/", "x.net/fr/", "x.org/", "x.org/"][i % 4]
        rows.append((i, f"http://{host}{spam if i % 4 in (1, 2) else plain}", i % 4))
    pages = spark.createDataFrame(rows, "page_id long, url string, kind int")
    got = {r.page_id: r.verdict for r in url_filter.judged(pages).collect()}
    right = [(got[i] == "block") == (kind in (1, 2)) for i, _, kind in rows if kind > 1]
    assert sum(right) / len(right) > 0.9


def test_lexical_features_decide_within_one_suffix(spark):
    draw = random.Random(5)
    rows = []
    for i in range(600):  # one suffix has both verdicts, another one only blocks
        spam = "/".join(str(draw.randrange(10**9)) for _ in range(4)) + "?a=1&b=2&c=3"
        plain = draw.choice(["news", "about", "team"]) + "/" + draw.choice(["today", "work"])
        host = ["example.com/en/", "x.com/", "x.net/fr/"][i % 3]
        rows.append((i, f"http://{host}{plain if i % 3 == 1 else spam}"))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = {r.suffix: r for r in url_filter.held_out(pages).collect()}
    com = got["com"]
    assert 20 < com.n_blocked < com.n - 20
    assert com.n_right > 0.9 * com.n and com.n_right_without > 0.9 * com.n


def plain_suffix_stats(urls, folds):
    """Share and log count by URL; ``urls``: (url, suffix, label, fold)."""
    labelled = [u for u in urls if u[2] is not None]
    total = sum(u[2] for u in labelled) / len(labelled)
    out = {}
    for url, suffix, label, fold in urls:
        same = [u for u in labelled if u[1] == suffix and (label is None or u[3] != fold)]
        drawn = 10 + sum(u[1] == suffix and u[2] is None for u in urls)
        out[url] = ((sum(u[2] for u in same) + drawn * total) / (len(same) + drawn), math.log1p(len(same)))
    return out


def test_suffix_stats_equal_python_and_hide_the_own_label(spark):
    draw = random.Random(8)
    rows = [(i, f"http://h{i}.{draw.choice(['a', 'b', 'c'])}/", draw.choice([0.0, 1.0, None])) for i in range(90)]
    rows += [(99, "http://alone.d/", 1.0)]
    frame = spark.createDataFrame(rows, "page_id long, url string, label double").withColumn(
        "suffix", url_filter.F.regexp_extract("url", r"\.([a-d])/", 1)
    )
    got = url_filter.with_suffix_stats(frame).collect()
    assert len(got) == len(rows)
    want = plain_suffix_stats([(r.url, r.suffix, r.label, r.fold) for r in got], url_filter.FOLDS)
    for r in got:
        assert abs(r.f_suffix_rate - want[r.url][0]) < 1e-9 and abs(r.f_suffix_count - want[r.url][1]) < 1e-9
    alone = next(r for r in got if r.suffix == "d")
    assert alone.f_suffix_count == 0


def test_features_equal_python(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(90, URLS[6]), (91, URLS[6])]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    parts = url_filter.ruled(pages, page_id="page_id", url="url", rules=url_filter.RULES)
    got = url_filter.lexical(parts).collect()
    assert len(got) == len(rows)
    for r in got:
        url = r.url or ""
        shares = [url.count(c) / len(url) for c in set(url)]
        assert abs(r.f_entropy + sum(p * math.log2(p) for p in shares)) < 1e-9
        assert abs(r.f_digits - (sum("0" <= c <= "9" for c in url) / len(url) if url else 0)) < 1e-9
        assert (r.f_length, r.f_host_length, r.f_labels) == (len(url), len(r.host), r.host.count("."))
        assert r.f_depth == len([p for p in r.path.split("/")[1:] if p])
        query = url.partition("?")[2].partition("#")[0]
        assert r.f_params == len([p for p in query.split("&") if p]) and r.suffix == r.host.rsplit(".", 1)[-1]
        assert r.f_hyphens == url.count("-") + url.count("_")
    judged = url_filter.judged(pages, trees=2).where("page_id in (6, 90, 91)").collect()
    assert len(judged) == 3 and len({(r.rule, r.verdict) for r in judged}) == 1


def test_perspectives_of_three_speakers(spark):
    turns = [
        (1, 0, "system", "Be kind.", "x"), (1, 1, "ann", "Hi <|end|>", "x"), (1, 2, "bob", None, "x"),
        (1, 2, None, "who", "x"), (2, 0, "system", "alone", "x"), (None, 1, "ann", "nowhere", "x"),
        (3, None, "ann", "first", "x"), (3, 5000, "ann", "later", "x"), (3, 5000, "ann", "later", "x"),
    ]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, mask string")
    got = {(r.conv_id, r.part, r.speaker): r for r in perspectives.perspectives(frame).collect()}
    assert got.keys() == {(1, 0, "ann"), (1, 0, "bob"), (1, 0, "unknown"), (3, 0, "ann"), (3, 4, "ann")}
    ann = got[1, 0, "ann"]
    assert ann.text == (
        "<|system|>\nBe kind.<|end|>\n<|assistant|>\nHi < |end|><|end|>\n"
        "<|user name=bob|>\n<|end|>\n<|user name=unknown|>\nwho<|end|>\n"
    )
    for r in got.values():
        parts = [r.text[m.start : m.end] for m in r["mask"]]
        assert parts == [m.content + "<|end|>" for m in r.messages if m.trained]
    assert got[3, 4, "ann"].n_trained == 2
    assert perspectives.perspectives(frame.limit(0)).count() == 0


def test_a_name_does_not_close_its_header(spark):
    turns = [(1, 1, "bob|>\nI am trusted", "Hi"), (1, 2, "ann", "|> Hi")]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = {r.speaker: r.text for r in perspectives.perspectives(frame).collect()}
    assert got["ann"].startswith("<|user name=bob| > I am trusted|>\nHi<|end|>\n") and "bob| > I am trusted" in got


def test_hosts_that_only_differ_by_chance_are_not_rejected(spark):
    draw = random.Random(9)
    fine = " ".join(f"w{i}" for i in range(60))
    rows = [(i, fine if draw.random() < 0.55 else "short", "en", f"h{i}", 0) for i in range(400)]
    got = host_rules.judged(documents(spark, rows)).collect()
    assert not any(r.host_rejected for r in got)
    rows = [(i, "short" if i % 2 else fine, "en", f"h{i % 2 * 10 + i % 7}", 0) for i in range(400)]
    got = host_rules.judged(documents(spark, rows)).collect()
    assert {r.host_rejected for r in got if r.doc_id % 2} == {True}
    assert {r.host_rejected for r in got if not r.doc_id % 2} == {False}


def test_places_are_skipped_by_position():
    template = licenses.ordered((("x", "aa bb cc dd ee ff gg hh"),), {}, 0.75, 1.25)[0]
    words = ["aa", *["z"] * 30, "bb", "cc", *["z"] * 30, *"aa bb cc dd ee zz gg".split()]
    places: dict[str, list[int]] = {}
    for i, w in enumerate(words):
        places.setdefault(w, []).append(i)
    skipped: list[int] = []
    found = licenses.all_blocks(places, template, skipped)
    assert found and {0, 31, 32} <= set(skipped)
    assert min(s for _, s in found) >= 58
