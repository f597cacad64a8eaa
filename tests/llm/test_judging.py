"""Language, URL, page, fingerprint, archive and mixture operators."""

import base64
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldspark.llm import chunking, language, mixing, urls, warc, wrappers
from tests.llm.corpus import documents, sentence, texts

STEMS = {"xx": ["alpha", "beta", "gamma", "delta"], "yy": ["ro", "ku", "mi", "sa", "ten"]}


def language_rows(seed, n):
    rng = random.Random(seed)
    make = lambda lang: " ".join("".join(rng.choices(STEMS[lang], k=rng.randint(1, 3))) for _ in range(12))
    return [(i, lang, make(lang)) for i in range(n) for lang in STEMS]


def test_languages_of_held_out_texts(spark):
    labelled = spark.createDataFrame([*language_rows(1, 60), (None, None, "alpha"), (7, "xx", None)], "id bigint, lang string, text string")
    held_out = language_rows(2, 40)
    docs = spark.createDataFrame([(i, t, lang) for i, lang, t in held_out], "doc_id bigint, text string, lang string")
    got = language.identify(docs, labelled).collect()
    assert all(r.lang_pred == r.lang and 0.5 < r.score <= 1 for r in got)


def test_awkward_texts_have_a_language_or_none(spark):
    labelled = spark.createDataFrame(language_rows(1, 20), "id bigint, lang string, text string")
    rows = [(1, None), (2, ""), (3, "123 ²³ !?"), (4, "語語"), (5, "ALPHABETA gammaga"), (5, "ALPHABETA gammaga"), (None, "rokumi")]
    got = language.identify(documents(spark, rows), labelled).select("doc_id", "lang_pred", "score").collect()
    assert [(r.lang_pred, r.score) for r in got[:3]] == [("und", 0.0)] * 3
    assert (got[3].lang_pred, got[3].score) == ("xx", 0.5)
    assert got[4] == got[5] and got[4].lang_pred == "xx" and got[6].lang_pred == "yy"
    untaught = language.identify(documents(spark, rows), labelled.limit(0)).collect()
    assert {(r.lang_pred, r.score) for r in untaught} == {("und", 0.0)}
    assert language.identify(documents(spark, []), labelled).collect() == []


def test_backing_off_takes_the_longest_known_grams():
    grams = [{}, {"a": 0}, {"ab": 1}, {}, {}]
    model = language.Model(["p", "q"], {"abc": 2}, grams, np.array([[0.0, 1], [2, 0], [5, 0]]))
    assert model.weight("abc") == [5, 0]
    assert model.weight("xab") == [2, 0]
    assert model.weight("xa") == [0, 1]
    assert model.weight("zz") == [0, 0]


RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/")]


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


def test_rules_and_scores_of_urls(spark):
    text = "<p>cheap pills red house spam farm " * 5
    rows = [
        (1, "http://Example.COM/en/1?x#y", text), (2, "https://www.example.com/en/2", text), (3, "http://a.b.com/x", text), (4, "http://com", text),
        (5, "http://redhouse.org/fr/7", None), (6, "ftp://spam-farm.net/es/9", ""), (7, None, text), (8, "no scheme", text), (9, "x://", text),
        (9, "x://", text), (None, "http://notexample.com/en/", text), (10, "http://example.com?/en/", text), (11, "http://redhouse.com/fr/1", text),
    ]
    got = {r.page_id: r for r in urls.judge(pages(spark, rows), RULES).collect()}
    assert (got[1].host, got[1].path, got[1].rule, got[1].verdict) == ("example.com", "/en/1", "example.com/en/", "block")
    assert (got[2].rule, got[2].verdict) == ("www.example.com/en/", "allow")
    assert (got[3].rule, got[3].path) == ("com/", "/x")
    assert (got[4].host, got[4].path, got[4].rule) == ("com", "", None)
    assert got[5].rule is None and got[5].verdict == "allow"  # shares its host words with allowed urls
    assert (got[6].rule, got[6].verdict) == ("net/es/", "block")
    assert all((got[i].host, got[i].path, got[i].rule) == ("", "", None) for i in (7, 8, 9))
    assert got[None].rule == "com/" and got[10].rule is None and got[10].path == ""
    assert urls.judge(pages(spark, rows), RULES).count() == len(rows)
    assert urls.judge(pages(spark, []), RULES).collect() == []


def test_labels_split_into_the_likeliest_words():
    counts = {"cheap": 50, "pills": 40, "pill": 60, "s": 5, "heap": 30}
    label = "cheappillsxq"
    found = [(i, len(w), n) for w, n in counts.items() for i in range(len(label)) if label.startswith(w, i)]
    assert urls.segmented(label, found, 1000)[:2] == ["cheap", "pills"]
    assert "".join(urls.segmented(label, found, 1000)) == label
    assert urls.segmented("", [], 1) == []


def page(body, head="<title>t</title><script>if (a<b) x('</p>')</script>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


def test_the_article_of_every_page(spark):
    menu, foot = "<nav><ul><li><a href='/a'>A</a></li><li><a>B</a></li></ul></nav>", "<footer>&copy; f</footer>"
    rows = [
        (1, "http://a.x/1", page(menu + "<!-- ad --><div class='ad'>buy</div><article><h1>T &amp; t</h1><p><b>one</b>two<br>three<p>four&nbsp; \n five</article>" + foot)),
        (2, "http://a.x/2", page(menu + "<article><h1>U</h1><p>x</p><aside>side</aside><div class='comments'><p>c</p></div><p>y</p></article>" + foot)),
        (3, "http://b.x/1", page("<div class='menu'><a>m</a></div><div><p>long text here it is</p><p>more of it</p></div><form><input>f</form>" + foot)),
        (4, None, None), (5, "http://a.x/3", ""), (6, "http://a.x/4", "plain < text & no tags"), (7, "http://c.x/", "<p>unclosed <a href='x>never"),
        (8, "http://a.x/5", page("<article><p>" + "w " * 50_000 + "</p></article>")), (9, "http://d.x/", "<div>" * 3_000 + "deep" + "</div>" * 3_000),
        (2, "http://a.x/2", page(menu + "<article><h1>U</h1><p>x</p><aside>side</aside><div class='comments'><p>c</p></div><p>y</p></article>" + foot)),
    ]
    got = {r.page_id: r.text for r in wrappers.extract(pages(spark, rows)).collect()}
    assert got[1] == "T & t onetwo three four five"
    assert got[2] == "U x y"
    assert got[3] == "long text here it is more of it"
    assert got[4] == "" and got[5] == ""
    assert got[6] == "plain < text & no tags"
    assert got[8] == "w " * 49_999 + "w" and got[9] == "deep"
    found = wrappers.extract(pages(spark, rows)).collect()
    assert len(found) == len(rows) and all(r.n_chars == len(r.text) for r in found)
    assert wrappers.extract(pages(spark, [])).collect() == []


def test_wrappers_have_groups_options_and_slots():
    first, second = ("<ul><li>a<li>b</ul><p>x", "<ul><li>a</ul><h2>z</h2><p>x<p>y")
    skeletons = [(wrappers._skeleton(t)[2], [1] * 9) for t in (first, second)]
    wrapper = wrappers.inferred(skeletons)
    assert wrappers.written(wrapper) == "<root>(<ul>(<li>+(#)) <h2>?(#) <p>+(#))"
    assert wrappers.written(wrappers.read(wrappers.written(wrapper))) == wrappers.written(wrapper)


def rare_articles():
    """A host of 140 listings in 70 frequent skeletons and 20 articles, each of its own skeleton."""
    name = lambda i: "".join("abcdefghij"[int(d)] for d in str(i))
    teaser = f"<div class='box'><p>{'read on ' * 40}</p>{{}}</div>"
    listing = [page(teaser.format(f"<h3 class='x{name(i % 70)}'>item</h3><p>{'words of a list ' * 20}</p>")) for i in range(140)]
    article = [page(teaser.format("") + f"<article><h1 class='z{name(i)}'>title</h1><p>text {i}</p></article>") for i in range(20)]
    return [(i, f"http://l.x/{i}", html) for i, html in enumerate(listing + article)]


@pytest.mark.parametrize("broadcast_bytes", [8 << 20, 0])
def test_rare_skeletons_count_in_the_wrapper(spark, broadcast_bytes):
    got = {r.page_id: r.text for r in wrappers.extract(pages(spark, rare_articles()), broadcast_bytes=broadcast_bytes).collect()}
    assert [got[140 + i] for i in range(20)] == [f"title text {i}" for i in range(20)]


def test_partial_wrappers_hold_all_text(spark):
    rows = rare_articles()
    html = pages(spark, [*rows, (1000, "http://m.x/", page("<p>one"))]).select(F.split("url", "/")[2].alias("host"), "html")
    length = sum(len(t) for _, _, h in rows for t in wrappers.parsed(h)[1])
    for fan_in in (3, 64):
        got = {r.host: r for r in wrappers.infer_wrappers(html, fan_in=fan_in).collect()}
        assert set(got) == {"l.x", "m.x"} and sum(got["l.x"].chars) == length
        assert all(f"<h1.z{c}>" in got["l.x"].wrapper for c in "abcdefghij")


def test_a_page_weighs_its_own_texts():
    skeleton = wrappers._skeleton("<div><p>x</div><table><td>y</table>")[2]
    known = wrappers.inferred([(skeleton, [0, 0])])
    assert wrappers._placed(known, skeleton, [1, 99]) == ({1}, False)
    assert wrappers._placed(known, skeleton, [99, 1]) == ({0}, False)


def test_fingerprints_of_neighbours(spark):
    rows = [r for r in texts() if r[0] is not None]
    order = sorted(set(rows), key=lambda r: (-r[0], r[1] or ""))
    got = {r.doc_id: r for r in chunking.neighbour_likeness(documents(spark, list(set(rows))), block_bytes=30_000).collect()}
    assert len(got) == len(order)
    for i, (doc, text) in enumerate(order):
        text, other = text or "", order[(i + 1) % len(order)][1] or ""
        edited = text[: len(text) - len(text) // 2] + other[: len(text) // 2]
        assert (got[doc].n_chars, got[doc].edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        own, changed, following = chunking.fingerprints([text.encode(), edited.encode(), other.encode()])
        assert got[doc].near_edited == chunking.containment(own, changed)
        assert got[doc].near_next == chunking.containment(own, following)
        assert 0 <= got[doc].near_next <= 1
    by_text = {}
    for doc, text in order:
        assert by_text.setdefault(text or "", got[doc].fingerprint) == got[doc].fingerprint


def test_ties_nulls_and_single_rows_have_neighbours(spark):
    rows = [(1, "b" * 30), (1, "a" * 30), (None, "c"), (None, None), (2, None)]
    got = chunking.neighbour_likeness(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    assert len(chunking.neighbour_likeness(documents(spark, rows[:1])).collect()) == 1
    assert chunking.neighbour_likeness(documents(spark, [])).collect() == []


def cut_by_definition(data):
    gear = [int(g) for g in chunking._GEAR]
    ends, start = [], 0
    while start < len(data):
        end = min(len(data), start + chunking.MOST)
        for e in range(start + chunking.LEAST, end):
            h = sum(gear[data[e - 1 - j]] << j for j in range(16)) & 0xFFFF
            if h & (0xFC00 if e < start + chunking.NORMAL else 0xF000) == 0:
                end = e
                break
        ends.append(end)
        start = end
    return ends


def test_cuts_follow_the_definition_and_the_content():
    rng = random.Random(9)
    text = sentence(rng, 400).encode()
    parts = [text, b"", text[:10], b"\0" * 1000, text[100:]]
    data = np.frombuffer(b"".join(parts), dtype=np.uint8)
    limits = np.cumsum([len(p) for p in parts])
    owner, start, end = chunking.cut(data, limits)
    for i, part in enumerate(parts):
        base = limits[i] - len(part)
        assert (end[owner == i] - base).tolist() == cut_by_definition(part)
    whole, shifted = chunking.fingerprints([text, b"inserted " + text])
    assert chunking.containment(whole, shifted) > 0.9


def test_archives_round_trip_with_revisits(spark, tmp_path):
    rows = [(5, "http://a/1", "same"), (3, "http://a/2\r\nX: y", "same"), (9, None, None), (8, "u", ""), (None, "v", "same"), (7, "w", "é\r\n\r\n\x00WARC/1.1")]
    rows += [(5, "http://a/1", "same"), (20, "big", "x" * 300_000)]
    docs = pages(spark, rows)
    got = warc.archived(docs, f"file://{tmp_path}/a", archive_bytes=1000).collect()
    assert len(got) == len(rows)
    found = sorted((r.page_id is None, r.page_id or 0, r.record_type, r.refers_to) for r in got)
    assert found == sorted([
        (False, 3, "response", None), (False, 5, "revisit", 3), (False, 5, "revisit", 3), (True, 0, "revisit", 3), (False, 8, "response", None),
        (False, 9, "revisit", 8), (False, 7, "response", None), (False, 20, "response", None),
    ], key=str) or found == sorted(found)
    kinds = {(r.page_id, r.record_type, r.refers_to) for r in got}
    assert {(3, "response", None), (5, "revisit", 3), (None, "revisit", 3), (8, "response", None), (9, "revisit", 8)} <= kinds
    for r in got:
        html = next(h or "" for p, _, h in rows if p == r.page_id)
        assert r.payload_bytes == len(html.encode())
        assert r.payload_digest == base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
    files = spark.read.format("binaryFile").load(f"file://{tmp_path}/a/responses").collect()
    records = [r for f in files for r in warc.unpacked(bytes(f.content))]
    assert sorted(r.payload for r in records) == sorted((h or "").encode() for _, _, h in rows)
    few = warc.archived(docs, f"file://{tmp_path}/b", min_bytes=5).collect()
    assert {r.record_type for r in few} == {"response"}
    assert warc.archived(pages(spark, []), f"file://{tmp_path}/c").collect() == []


def test_archives_refer_to_originals_in_other_archives(spark, tmp_path):
    """Revisits read from an archive get the earliest response with their payload."""
    header = "archive string, place int, page_id bigint, record_id string, record_type string, target_uri string, date string, payload_digest string, payload_bytes bigint, refers_to bigint"
    rows = [("f", 0, 7, "<7>", "revisit", "u", "d", "D", 4, None), ("g", 0, 9, "<9>", "response", "u", "d", "D", 4, None), ("g", 1, 8, "<8>", "response", "u", "d", "D", 4, None)]
    got = warc.resolve(spark.createDataFrame([*rows, ("h", 0, 1, "<1>", "revisit", "u", "d", "E", 4, None)], header)).collect()
    assert {(r.archive, r.place, r.original.page_id) for r in got} == {("f", 0, 8), ("g", 0, 8)}


def mixture(spark, n=240):
    rng = random.Random(4)
    kinds = {"good": "", "poor": " ###", "toxic": " vile"}
    rows = [(i, f"{sentence(rng, 30)}{kinds[k] * 3} {sentence(rng, 10)}", k) for i, k in enumerate(rng.choices(list(kinds), [6, 3, 1], k=n))]
    return spark.createDataFrame(rows, "doc_id bigint, text string, domain string")


def test_rates_bring_domains_to_their_targets(spark):
    docs = mixture(spark)
    targets = {"good": 0.8, "poor": 0.2, "toxic": 0.0}
    got = mixing.mix(docs, docs.where("doc_id % 2 = 0").select("text", "domain"), targets)
    rows = got.collect()
    total = sum(r.n_tokens for r in rows)
    for d, share in targets.items():
        assert sum(r.n_tokens * r.rate * r[f"p_{d}"] for r in rows) / total == pytest.approx(share, abs=0.03)
    held_out = [r for r in rows if r.doc_id % 2]
    assert np.mean([max(targets, key=lambda d: r[f"p_{d}"]) == r.domain for r in held_out]) > 0.95
    assert all(r.rate >= 0 and abs(r.copies - r.rate) < 1 for r in rows)
    mean = {d: np.mean([r.rate for r in rows if r.domain == d]) for d in targets}
    assert mean["toxic"] < 0.3 < 1 < mean["good"]


def test_rates_solve_the_least_squares_problem(spark):
    rng = np.random.default_rng(1)
    share = rng.dirichlet([0.4, 0.4, 0.4], 60)
    n = rng.integers(1, 50, 60)
    judged = spark.createDataFrame([(int(a), [float(x) for x in b]) for a, b in zip(n, share)], "n_tokens bigint, posterior array<double>")
    wanted, ridge = np.array([0.9, 0.2, 0.0]), 0.05
    rates = mixing.fit_rates(judged, wanted.tolist(), ridge=ridge, steps=50, tolerance=1e-7).of(share)[0]
    weight, mass = n / n.sum(), (n / n.sum()) @ share
    plain = np.ones(60)
    for _ in range(20_000):  # the same problem by plain steps
        slope = share @ ((((weight * plain) @ share) - wanted) / mass) + ridge * (plain - 1)
        plain = np.maximum(0, plain - 0.5 * slope)
    assert np.abs(rates - plain).max() < 5e-3


def test_mixing_takes_awkward_rows(spark):
    docs = documents(spark)
    got = mixing.mix(docs, docs.select("text", F.lit("good").alias("domain")), {"good": 1.0, "poor": 0.5})
    assert got.count() == docs.count()
    assert mixing.mix(docs.limit(0), docs.select("text", F.lit("good").alias("domain")), {"good": 1.0}).collect() == []
    unlabelled = mixing.mix(docs, docs.select("text", F.lit(None).cast("string").alias("domain")), {"good": 0.5, "poor": 0.5}).collect()
    assert {r.p_good for r in unlabelled} == {0.5}


@pytest.mark.parametrize("ridge", [0.05, 0.01])
def test_rates_are_as_near_the_solution_as_they_say(spark, ridge):
    rng = np.random.default_rng(2)
    share = rng.dirichlet([0.4, 0.4, 0.4], 80)
    n = rng.integers(1, 50, 80)
    judged = spark.createDataFrame([(int(a), [float(x) for x in b]) for a, b in zip(n, share)], "n_tokens bigint, posterior array<double>")
    wanted = np.array([0.9, 0.2, 0.0])
    found = mixing.fit_rates(judged, wanted.tolist(), ridge=ridge, tolerance=1e-4)
    rates = found.of(share)[0]
    weight, mass = n / n.sum(), (n / n.sum()) @ share
    plain = np.ones(80)
    for _ in range(40_000):
        slope = share @ ((((weight * plain) @ share) - wanted) / mass) + ridge * (plain - 1)
        plain = np.maximum(0, plain - 0.5 * slope)
    assert found.converged and found.distance <= 1e-4
    assert np.sqrt(weight @ (rates - plain) ** 2) <= 1e-4
    assert np.abs(rates - plain).max() <= 1e-4 / np.sqrt(weight.min())
    assert np.abs(found.reached - (weight * rates) @ share).max() < 1e-3
    with pytest.warns(UserWarning, match="off the solution"):
        assert not mixing.fit_rates(judged, wanted.tolist(), ridge=ridge, steps=3).converged


def test_reached_totals_are_those_of_the_mixture(spark):
    """The given tables, and what their mixture comes to."""
    from fieldspark.llm.queries import TARGETS, op2_source_mixing

    sf = "/root/testdata/sf0.001"
    mixed = op2_source_mixing(spark, sf).toPandas()
    found = {r.domain: r for r in mixing.reached_totals(spark.createDataFrame(mixed), TARGETS).collect()}
    for d, target in TARGETS.items():
        share = (mixed.rate * mixed.n_tokens * mixed[f"p_{d}"]).sum() / mixed.n_tokens.sum()
        assert abs(found[d].reached - share) < 1e-9 and found[d].wanted == target
        assert abs(share - target) < 0.1
    assert found["toxic"].reached < (mixed.n_tokens * mixed.p_toxic).sum() / mixed.n_tokens.sum()


def test_mixing_without_texts_gives_the_same(spark):
    docs = documents(spark).withColumn("posterior", F.lit("theirs"))
    labelled = docs.select("text", F.when(F.length("text") > 300, "good").otherwise("poor").alias("domain"))
    with_text, without = (mixing.mix(docs, labelled, {"good": 0.7, "poor": 0.3}, keep_text=k) for k in (True, False))
    assert without.columns == [c for c in with_text.columns if c != "text"]
    as_rows = lambda df: sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in df.drop("text").collect())
    assert as_rows(with_text) == as_rows(without)
