"""HTML extraction, PII, WARC, chat formatting and URL filters."""

from __future__ import annotations

import datetime
import hashlib
import html
import random
import re

import brute
import pytest
from tidewell.llm import chat, html_extract, pii, queries, url_filter, warc
from tidewell.llm.sql import ORACLES


def read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- HTML


def test_article_of_every_test_page(spark, sf_dir):
    pages = read(spark, sf_dir, "pages")
    got = {r.page_id: r for r in html_extract.extract(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        want = "\n".join(b for b in blocks if b)
        assert (got[r.page_id].text, got[r.page_id].n_chars, got[r.page_id].url) == (want, len(want), r.url)


def inner_of(page):
    return re.search(r"<article>(.*?)</article>", page, re.S)[1]


def plain_blocks(inner):
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
    return "\n".join(b for b in blocks if b)


@pytest.mark.parametrize("wrapped", ["<div class=x>{}</div>", "<div>{}</div>", "<div id=page><div class=left>{}</div></div>", "<table><tr><td><div class=c7>{}</div></td></tr></table>"])
def test_scoring_finds_pages_without_an_article_element(spark, sf_dir, wrapped):
    """Paragraphs lie up to seven divs deep, each at a depth of its own."""
    random.seed(12)
    for r in read(spark, sf_dir, "pages").collect():
        inner = inner_of(r.html)
        nested = re.sub(r"<p>.*?</p>", lambda m: "<div>" * (k := random.randrange(8)) + m[0] + "</div>" * k, inner, flags=re.S)
        page = re.sub(r"<article>.*?</article>", lambda _, x=nested: wrapped.format(x), r.html, flags=re.S)
        assert html_extract.main_text(page) == plain_blocks(inner)


LONG = "A long paragraph, with commas, and words, " * 12 + "ends."


@pytest.mark.parametrize("outer", ["<div>{}</div>", "<div class=x><div>{}</div></div>", "<article>{}</article>", "<main>{}</main>", "<div id=a><article>{}</article></div>"])
@pytest.mark.parametrize("part", ["<section><p>short</p></section>", "<ul><li>short</ul>", "<table><tr><td>short</table>", "<blockquote>short</blockquote>", "<pre>short</pre>", "<h3>short</h3>", "<div><div><div><p>short</p></div></div></div>", "<p class='share-price'>short</p>", "short", "<figure><figcaption>short</figcaption></figure>"])
def test_short_parts_of_an_article_stay(outer, part):
    for body, want in ((f"<p>{LONG}</p>{part}", f"{LONG}\nshort"), (f"{part}<div><p>{LONG}</p></div>", f"short\n{LONG}"), (f"<section><p>{LONG}</p></section>{part}<section><p>{LONG}</p></section>", f"{LONG}\nshort\n{LONG}")):
        page = f"<body><nav><ul><li><a href=1>menu</a></ul></nav>{outer.format(body)}<ul><li><a href=2>one</a><li><a href=3>two</a></ul><footer>end</footer></body>"
        assert html_extract.main_text(page) == want


def test_lists_of_links_beside_the_article_go():
    page = f"<body><div id=w><div><p>{LONG}</p><p>{LONG}</p></div><div><a href=1>one two three</a> <a href=2>four five</a></div></div></body>"
    assert html_extract.main_text(page) == f"{LONG}\n{LONG}"


PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site</h1></header><div id="cookie-notice"><p>We use cookies, and more cookies, and partners, and so on.</p></div>
<div class="wrap"><div class="sidebar"><p>Other, news, of, the, day, is, here, today.</p></div>
<div class="post-content"><h2>A &amp; B</h2><p>First   paragraph, with
some <a href="x>y">link</a> text, <i>and</i> so on.<p>Second &lt;one&gt;&nbsp;here, longer than it was, all the same.
<ul><li>item one<li>item two</ul><script>var a = "</p><p>no</p>";</script><!-- <p>no</p> -->
<form><p>Your name, please, and more</p></form><table><tr><td>x<td>y<tr><td>z</table>
<div class="advert"><p>Buy, buy, buy, buy, buy, buy now.</p></div><blockquote><p>Quoted, it was.</p></blockquote></div>
<section id="comments"><p>I, for one, like, this, and, that, very, much, indeed.</p></section></div>
<footer><p>Legal, text, here.</p></footer></body></html>"""


def test_parts_that_are_no_article_go():
    assert html_extract.main_text(PAGE) == "A & B\nFirst paragraph, with some link text, and so on.\nSecond <one> here, longer than it was, all the same.\nitem one\nitem two\nx y\nz\nQuoted, it was."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("   ", ""), ("<html></html>", ""), ("plain words only", "plain words only"),
        ("<p>a</p>", "a"), ("<div><div><p>a<p>b", "a\nb"), ("a < b <p>c", "a < b\nc"), ("<p>x<br>y</p>", "x y"),
        ("<article class=post><p>x, y</p><article class=comment><p>c, d, e, f, g, h</p></article></article>", "x, y"),
        ("<article><section><p>" + "long, text, here, " * 50 + "</p></section><section><p>short</p></section></article>", " ".join(["long, text, here,"] * 50) + "\nshort"),
        ("<head><title>t</title><p>no body, here<a href=1>x<a href=2>y</a> z", "no body, herexy z"),
        ("<div class='content with-sidebar'><p>a, b</p><div class='site-ad-box'><p>c, d, e</p></div></div>", "a, b"),
        ("<div class=part><p>first, one</p></div><div class=part><p>x</p></div><div class=rest>y</div>", "first, one\nx"),
        ("<body><form><article><p>inside, a form</p></article></form></body>", "inside, a form"),
        ("<p title=\"a > b\">q</p>", "q"), ("<p title='never closed>q</p>", "q"), ("<script>never closed <p>x</p>", ""), ("<!-- never closed <p>x</p>", ""),
        ("<p>&#233;&eacute;&#x1F600; &copy; &unknown;</p>", "éé\U0001f600 © &unknown;"), ("</p></div><p>a</b></p>", "a"),
    ],
)
def test_awkward_pages(page, text):
    assert html_extract.main_text(page) == text


PROSE = "Earlier papers treat the same case with other means and less data, and so on."


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<body><div><section><p>" + "a, " * 8 + "b</p></section><section><p>" + "c, " * 5 + "d</p></section></div></body>", "a, " * 8 + "b\n" + "c, " * 5 + "d"),
        ("<body><div><section><p>" + "a, " * 90 + "b</p></section><section><p>short</p></section></div></body>", "a, " * 90 + "b\nshort"),
        ("<body><section><p>" + "a, " * 8 + "b</p></section><section><p>" + "c, " * 5 + "d</p></section></body>", "a, " * 8 + "b\n" + "c, " * 5 + "d"),
        (f"<article><p>x, y</p><section id='related-work'><h2 id=notice>Notice</h2><p>{PROSE}</p></section></article>", f"x, y\nNotice\n{PROSE}"),
        ("<article><p>x, y</p><div class=related><a href=1>one two three four five six</a> <a href=2>seven eight nine ten eleven twelve thirteen</a></div></article>", "x, y"),
        (f"<article><p>x, y</p><div class=comments><p>{PROSE}</p></div></article><div class=related><p>{PROSE}</p></div>", "x, y"),
    ],
)
def test_parts_of_the_article_stay(page, text):
    assert html_extract.main_text(page) == text


def test_long_and_deep_pages_take_linear_time():
    deep = "<div>" * 30_000 + "<p>a, b</p>" + "<b>" * 30_000
    assert html_extract.main_text(deep) == "a, b"
    assert html_extract.main_text("<article>" + "<p>word, word</p>" * 50_000 + "</article>").count("\n") == 49_999
    assert html_extract.main_text("<p a='" * 20_000) is not None


def test_extract_of_awkward_tables(spark):
    rows = [(1, None, None, "x"), (None, "u", "<p>a</p>", "y"), (1, None, None, "x")]
    out = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in out) == [(0, "a", 1), (1, "", 0), (1, "", 0)]
    assert html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# --- PII

AWKWARD = [
    None, "", "a@b", "a@b.c_d@e.f", "x.y@z.w.", "a@b.c@d.e", "@a.b", "1.2.3.4.5.6.7.8", "01.002.0003.255", "256.1.1.1 1.1.1.256", "1.2.3", "9.9.9.9@x.y",
    "4111 1111 1111 1111", "4111-1111-1111-1111 ", "4111  1111 1111 1111", "5 4111111111111111", "4111111111111112", "0" * 19, "0" * 20, "+1 (017) 555-7713", "+1 2", "+123456789.", "+1 23 45 67 89 - ( ) x", "++123456789 +", "+49 30 1234567\n+49 30 7654321",
    "ü" * 50 + " é@ü.com me@host.example.org ü 10.0.0.1", "x" * 30_000, "1." * 5000, "a.b." * 5000, "-" * 20_000 + "@a.b", "+1 " + " " * 20_000, "\U0001f600 a@b.cc \U0001f600 10.1.1.1",
    "me@host.org " * 400, "1" * 30_000, "a" * 20_000 + "1",
]


def texts_frame(spark, texts):
    return spark.createDataFrame([(i, t, "k", 3) for i, t in enumerate(texts)], "doc_id long, text string, spans string, __m int")


def test_base_spans_match_brute_force(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text").collect()
    texts = [*AWKWARD, *(r.text for r in docs)]
    out = pii.digest(pii.find(texts_frame(spark, texts))).orderBy("doc_id").collect()
    for t, r in zip(texts, out, strict=True):
        counts, sha, _ = brute.pii_digest(t)
        assert ([r.n_email, r.n_ip, r.n_card, r.n_phone], r.base_sha256) == (counts, sha), t


def test_random_texts_match_brute_force(spark):
    random.seed(6)
    texts = ["".join(random.choice("0123456789 -.+()@ab%_\n\té") for _ in range(random.randrange(120))) for _ in range(400)]
    out = pii.digest(pii.find(texts_frame(spark, texts), least_seeds=10**6)).orderBy("doc_id").collect()
    for t, r in zip(texts, out, strict=True):
        counts, sha, listed = brute.pii_digest(t)
        assert ([r.n_email, r.n_ip, r.n_card, r.n_phone], r.base_sha256, r.spans) == (counts, sha, listed), t


def listed(text, added):
    every = brute.pii_spans(text) + added
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(every, key=lambda x: (brute.NAMES.index(x[0]), *x[1:])))


def test_added_spans_match_a_plain_scorer(spark, sf_dir):
    random.seed(8)
    names, marks = ["+49 30 {:07d}", "a{}@host.org", "10.0.{}.1", "{:08d}", '"{:040x}"'], ["call", "me", "on", "token", "=", "at", "ok,", "x1"]
    mixed = [" ".join(random.choice(marks) if random.random() < 0.75 else random.choice(names).format(random.randrange(200)) for _ in range(30)).replace("ok,", random.choice(["ok,", "\n"])) for _ in range(300)]
    shop = [r.text for r in read(spark, sf_dir, "documents").select("text").collect()] + LABELS_TEXTS + mixed
    added = brute.pii_added(shop)
    assert any(k != "secret" for x in added for k, *_ in x)
    got = pii.digest(pii.find(texts_frame(spark, shop))).orderBy("doc_id").collect()
    for t, x, r in zip(shop, added, got, strict=True):
        assert (r.spans, r.n_added, r.n_spans) == (listed(t, x), len(x), len(brute.pii_spans(t)) + len(x)), t


def contexts(spark):
    texts = [f"Hello. Please call me on +49 30 12345{k:02d}, thanks" for k in range(5)]
    texts += ["He said: please CALL ME: on 555-201-34 tomorrow", "no context 555-201-34", "call me on time 5", "the year 1999 was good"]
    texts += [f"version number 12345{k}" for k in range(5)]
    return texts_frame(spark, texts)


def test_contexts_find_unseen_identifiers(spark):
    out = {r.doc_id: r for r in pii.digest(pii.find(contexts(spark))).collect()}
    found = len("He said: please CALL ME: on ")
    assert out[5].spans == f"phone:{found}:{found + 10}" and out[5].n_phone == 0
    assert [out[k].spans for k in range(6, 14)] == [""] * 8


def test_a_round_carries_trust_to_new_contexts(spark):
    texts = [f"please ring me on +49 30 1234{k:03d}." for k in range(100)]
    texts += [f"ring me on 777-000-{k}0 now" for k in range(10)]
    texts += [f"my extension is 777-000-{k}0 now" for k in range(10)] + ["my extension is 888-111-22"]
    instances = pii._instances(pii.base_spans(texts_frame(spark, texts)))
    first = {"me on": 3, "ring me on _": 3, "on _": 3, "on +9 9 9": 3}
    assert {r.pattern: r.kind for r in pii.patterns(instances, rounds=1).collect()} == first
    second = {"extension is": 3, "my extension is _": 3, "is _": 3, "is 9-9-9": 3, "on 9-9-9": 3, "_ now": 3, "on _ now": 3, "is _ now": 3}
    got = {r.pattern: (r.kind, r.useful) for r in pii.patterns(instances, rounds=3).collect()}
    assert {k: v for k, (v, _) in got.items()} == {**first, **second} and got["is _"][1] and not got["on +9 9 9"][1]
    assert pii.digest(pii.find(texts_frame(spark, texts))).where("doc_id = 120").first().spans == "phone:16:26"


@pytest.mark.parametrize("inline", [500, -1])
def test_redaction(spark, monkeypatch, inline):
    monkeypatch.setattr(pii, "INLINE", inline)
    extra = "__marks __doc __hash __h __kept __m marks shown hash of every spans words found_in".split()
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` int" for c in extra)
    texts = ["é me@host.org and 10.0.0.1.", None, "", "clean", "9.9.9.9@x.yy z", "+1 555 123 4567, 4111111111111111"]
    docs = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), *range(len(extra))) for i, t in enumerate(texts)], schema)
    twice = docs.unionByName(docs)
    got = pii.redact(twice)
    assert got.dtypes == docs.dtypes
    out = got.orderBy("doc_id").collect()
    assert [r.text for r in out[::2]][:5] == ["é [EMAIL] and [IP].", None, "", "clean", "[EMAIL] z"]
    assert out[10].text == "[PHONE], [CARD]"
    assert [r.n_chars for r in out[::2]][:4] == [len("é [EMAIL] and [IP]."), None, 0, 5]
    assert out[0] == out[1] and len(out) == 2 * len(texts) and {tuple(r)[5:] for r in out} == {tuple(range(len(extra)))}
    assert pii.redact(docs.limit(0)).count() == 0


HEX = "0123456789abcdef0123456789abcdef"


@pytest.mark.parametrize("inline", [500, -1])
def test_contexts_find_unseen_secrets(spark, monkeypatch, inline):
    monkeypatch.setattr(pii, "INLINE", inline)
    texts = [f'w{k} here token = "{k:02d}{HEX}" and so on' for k in range(12)] + [f"NOW TOKEN = '{HEX.upper()}'!!", "the token is 12", f"a commit {HEX} only"]
    assert [r.text for r in pii.redact(texts_frame(spark, texts)).orderBy("doc_id").collect()] == [*[f'w{k} here token = "[SECRET]" and so on' for k in range(12)], "NOW TOKEN = '[SECRET]'!!", *texts[-2:]]


@pytest.mark.parametrize("inline", [500, -1])
def test_redaction_of_added_spans(spark, monkeypatch, inline):
    monkeypatch.setattr(pii, "INLINE", inline)
    out = {r.doc_id: r.text for r in pii.redact(contexts(spark)).collect()}
    assert out[5] == "He said: please CALL ME: on [PHONE] tomorrow" and out[6] == "no context 555-201-34" and out[0] == "Hello. Please call me on [PHONE], thanks"


SEEDS = [f"Tel: +49 30 12345{k:02d}, Fax: +49 30 76543{k:02d}\nFax: +49 30 55543{k:02d}\nplease call me on +49 30 99943{k:02d}" for k in range(20)]
LABELS = [
    ("Fax: 030-987654", "Fax: [PHONE]"),
    ("Tel: 030-123456, Fax: 030-987654.", "Tel: [PHONE], Fax: [PHONE]."),
    ("please call me on 123 456 789, thanks", "please call me on [PHONE], thanks"),
    ("please call me on (030/12 34 56)", "please call me on ([PHONE])"),
    ("please call me on 12 345x1", "please call me on 12 345x1"),
    ("please call me on 123456 10.0.0.1", "please call me on [PHONE] [IP]"),
    ("Note: 030-987654\nFax 12", "Note: 030-987654\nFax 12"),
]


@pytest.mark.parametrize("inline", [500, -1])
def test_one_label_and_spaced_identifiers(spark, monkeypatch, inline):
    monkeypatch.setattr(pii, "INLINE", inline)
    out = pii.redact(texts_frame(spark, SEEDS + [t for t, _ in LABELS])).orderBy("doc_id").collect()
    assert [r.text for r in out[20:]] == [want for _, want in LABELS]


LABELS_TEXTS = [*SEEDS, *(t for t, _ in LABELS)]


# --- WARC


def test_round_trip_matches_sql(spark, sf_dir):
    import duckdb

    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{sf_dir}/pages.parquet'")
    want = sorted(con.sql(f"SELECT page_id, payload_bytes, payload_digest, record_type, coalesce(refers_to, -1) AS refers_to FROM ({ORACLES['op8_warc']})").fetchall())
    got = sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, -1 if r.refers_to is None else r.refers_to) for r in queries.op8_warc(spark, sf_dir).collect())
    assert got == want


@pytest.mark.parametrize("few", [warc.BROADCAST, -1])
def test_awkward_captures(spark, monkeypatch, few):
    monkeypatch.setattr(warc, "BROADCAST", few)
    big, odd = "é" * 9000, "line\r\n\r\nWARC/1.1\r\n\r\n0\r\n\r\n" * 800
    rows = [(1, "http://a/ b", big), (2, None, big), (2, None, big), (None, None, odd), (None, None, odd), (3, "u", odd), (4, "u", None), (5, "", ""), (6, "u", "x" * 999), (7, "u", "x" * 999), (8, "u", "y" * 1000), (9, "u", "y" * 1000), (9, "u", "y" * 1000), (9, "u", big + "!"), (None, "u", "y" * 1000)]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, refers_to string")
    got = sorted(((r.page_id or 0), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to or 0) for r in warc.digest(warc.round_trip(pages)).collect())
    want = []
    top = {big: 2, "y" * 1000: 9}
    for page_id, _, text in rows:
        data = (text or "").encode()
        revisit = page_id is not None and text in top and page_id < top[text]
        want.append((page_id or 0, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", top[text] if revisit else 0))
    assert got == sorted(want)
    assert warc.round_trip(pages.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["a.warc", "a.warc.gz", "deep/er/a.warc.gz"])
def test_archives_by_any_name(spark, tmp_path, monkeypatch, name):
    import gzip

    monkeypatch.setattr(warc, "PIECE", 700)
    pack = gzip.compress if name.endswith("gz") else bytes
    payload = {k: f"page {k} ".encode() * (k * 400) for k in range(5)}
    records = [r + warc.END for k, p in payload.items() for r in warc.records_of(k, f"http://h/{k}", p, None, 1000)]
    records.insert(3, b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:1>\r\nContent-Length: 2\r\n\r\nhi" + warc.END)
    records += records[-3:]  # segments once more
    (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
    (tmp_path / name).write_bytes(b"".join(map(pack, records)))
    got = {r.page_id: bytes(r.payload) for r in warc.read_archives(spark, str(tmp_path)).collect()}
    assert got == payload
    (tmp_path / "more.zip").write_bytes(b"x")
    with pytest.raises(ValueError, match="no archive"):
        warc.read_archives(spark, str(tmp_path))


def test_broken_archives():
    whole = b"".join(r + warc.END for r in warc.records_of(1, "u", b"abc" * 50, None))
    assert len(list(warc.parse(whole[:-4]))) == 1 and list(warc.parse(b"")) == []
    for cut in (10, len(whole) - 9):
        with pytest.raises(ValueError, match="ends inside"):
            list(warc.parse(whole[:cut]))
    with pytest.raises(ValueError, match="no record"):
        list(warc.parse(b"junk\r\n\r\n"))


def test_segments_in_any_order_and_checked():
    payload = b"some payload " * 100
    parsed = list(warc.parse(b"".join(r + warc.END for r in warc.records_of(5, "u", payload, None, 300))))
    parts = [{"number": int(f["warc-segment-number"]), "total": int(f["warc-segment-total-length"]) if "warc-segment-total-length" in f else None, "block": b, "page_id": 5, "url": "u", "digest": "d"} for f, b in parsed]
    random.seed(1)
    random.shuffle(parts)
    assert warc.assembled("o", parts)[-1] == payload
    for lost in range(len(parts)):
        with pytest.raises(ValueError, match="missing"):
            warc.assembled("o", parts[:lost] + parts[lost + 1 :])


def test_chunked_framing():
    for data in (b"", b"x", b"a" * 4096, b"\r\n0\r\n\r\n" * 3000):
        assert warc.dechunked(warc.chunked(data)) == data
    assert warc.dechunked(b"3;ext=1\r\nabc\r\n0\r\nTrailer: x\r\n\r\n") == b"abc"
    with pytest.raises(ValueError, match="chunk"):
        warc.dechunked(b"2\r\nabc\r\n0\r\n\r\n")


# --- chat


def test_every_layout_becomes_the_same_turns():
    records = [
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"prompt": "q", "response": "a"}, {"prompt": "q", "completion": "a"}, {"question": "q", "answer": "a"}, {"instruction": "q", "output": "a"},
    ]
    for r in records:
        layout = chat.BY_FINGERPRINT[chat.fingerprint(chat.field_paths(r))]
        assert chat.canonical(r, layout) == [("user", "q"), ("assistant", "a")]


@pytest.mark.parametrize("text", ["", "<", "<|", "<\\|", "<\\\\|x|>", "<|im_end|>\n<|im_start|>assistant\nok", "a<", "|>", "<<|\\|"])
def test_escapes_are_reversible(text):
    assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
    assert chat.unescape_role(chat.escape_role(text + "\n\\n")) == text + "\n\\n"
    turns = [("user", text), ("assistant", text), (text, "x" + text)]
    formatted, spans = chat.render(turns)
    assert chat.read_back(formatted) == turns
    assert [chat.unescape(formatted[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


def test_chat_of_awkward_tables(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", None), (2, 1, "assistant", "b"), (2, 0, None, "a"), (2, 1, "assistant", "a"), (3, 0, "gpt", "x"), (None, None, "user", "n"), (5, 0, "system", "s"), (5, 1, "user", "u"), (5, 2, "assistant", "<|im_end|>"), (7, 0, "user", "é"), (7, 1, "user", "\U0001f600"), (9, 0, "odd\nrole", "t")]
    talks = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    got = {r.conv_id: r for r in chat.digest(chat.format_records(chat.as_records(talks))).collect()}
    turns = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] or 0, r[1] or 0, r[2] or "", r[3] or "")):
        turns.setdefault(conv, []).append((role or "", text or ""))
    assert set(got) == set(turns)
    for k, want in turns.items():
        loss = "".join(t for r, t in want if r == "assistant")
        assert (got[k].n_turns, got[k].turns_sha256) == (len(want), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in want).encode()).hexdigest())
        assert (got[k].loss_chars, got[k].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    odd = spark.createDataFrame([(1, None), (2, "no json"), (3, '{"x": 1}'), (4, "[]")], "conv_id long, record string")
    assert [r.layout for r in chat.format_records(odd).collect()] == [None] * 4
    assert chat.format_records(odd.limit(0)).count() == 0


# --- URL filters

D = datetime.date


def test_entries_hold_until_the_next(spark):
    entries = spark.createDataFrame([("Bad.org", "block", D(2024, 3, 1)), ("bad.org", "allow", D(2024, 5, 1)), ("bad.org", "review", D(2024, 5, 1)), ("good.bad.org", "allow", D(2024, 1, 1)), (None, "block", D(2024, 1, 1)), ("x.org", None, D(2024, 1, 1)), ("x.org", "block", None)], "pattern string, action string, listed_on date")
    urls = [
        ("http://bad.org/x", D(2024, 2, 29), "none"), ("http://BAD.org./x", D(2024, 3, 1), "block"), ("https://u:p@www.bad.org:80?q", D(2024, 4, 30), "block"),
        ("http://bad.org", D(2024, 5, 1), "review"), ("http://bad.org", D(2030, 1, 1), "review"), ("http://good.bad.org/", D(2024, 4, 1), "allow"), ("http://notbad.org", D(2024, 4, 1), "none"),
        ("no url", D(2024, 4, 1), "none"), (None, D(2024, 4, 1), "none"), ("http://bad.org", None, "none"), ("http://x.org", D(2024, 4, 1), "none"),
    ]
    captures = spark.createDataFrame([(i, u, d, "x") for i, (u, d, _) in enumerate(urls)], "page_id long, url string, fetched_on date, pattern string")
    for period, salts in ((32, 8), (1, 1), (100_000, 3)):
        out = url_filter.evaluate(captures.unionByName(captures), entries, period, salts).orderBy("page_id").collect()
        assert [r.action for r in out[::2]] == [a for *_, a in urls] and len(out) == 2 * len(urls)
    assert url_filter.evaluate(captures, entries.limit(0)).where("action != 'none'").count() == 0
    assert url_filter.evaluate(captures.limit(0), entries).count() == 0
    assert url_filter.keep_allowed(captures, entries).count() == len(urls) - 2


HOSTS = [
    ("http://[2001:db8::1]:80/", "[2001:db8::1]"), ("http://a@b@evil.com/", "evil.com"), ("http://evil.com\\@x/", "evil.com"), ("HTTP://Evil.COM.:8080?x=@y", "evil.com"),
    ("http:\\\\evil.com\\x", "evil.com"), ("https://u:p@evil.com#a@b", "evil.com"), ("http://evil.com/@good.org", "evil.com"), ("http://...", None), ("http://", None), ("evil.com", None), (None, None),
    ("http://10.0.0.1/", "10.0.0.1"), ("  http://evil.com ", "evil.com"), ("http://é.com:1", "é.com"),
]


def test_hosts(spark):
    rows = spark.createDataFrame([(k, u) for k, (u, _) in enumerate(HOSTS)], "k int, url string")
    got = rows.select("k", url_filter.host_of(rows["url"]).alias("host")).orderBy("k").collect()
    assert [r.host for r in got] == [h for _, h in HOSTS]


@pytest.mark.parametrize("hot", [url_filter.HOT, 1, 10**9])
def test_entries_have_the_hosts_form(spark, monkeypatch, hot):
    monkeypatch.setattr(url_filter, "HOT", hot)
    entries = spark.createDataFrame([(" Evil.com.", "block", D(2024, 1, 1)), ("[2001:db8::1]", "block", D(2024, 1, 1)), ("0.1", "block", D(2024, 1, 1)), ("10.0.0.1", "review", D(2024, 1, 1)), (" . ", "block", D(2024, 1, 1))], "pattern string, action string, listed_on date")
    captures = spark.createDataFrame([(k, u, D(2024, 2, 1)) for k, (u, _) in enumerate(HOSTS)] * 3, "page_id long, url string, fetched_on date")
    got = url_filter.evaluate(captures, entries).collect()
    want = {"evil.com": "block", "[2001:db8::1]": "block", "10.0.0.1": "review"}
    assert len(got) == 3 * len(HOSTS) and all(r.action == want.get(HOSTS[r.page_id][1], "none") for r in got)


def test_nothing_but_frames_on_native_paths(spark, sf_dir):
    for name in ("op7_pii", "op10_url_filter"):
        plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
