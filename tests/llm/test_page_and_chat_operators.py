"""HTML extraction, web archives, chats and the classifier."""

import base64
import hashlib
import html.parser
import random
import time
import io
import zipfile

import pytest

from tests.conftest import rows
from tests.llm import corpus
from yardline.llm import chat_format, html_text, quality_knn, warc

PAGES = "page_id long, url string, html string, host string, path string, text string"


def page(body, menu="<nav><a href='/'>Home</a></nav>"):
    return f"<!DOCTYPE html><html><head><title>T</title><script>var a='<p>x</p>'</script></head><body>{menu}{body}<footer>&copy; x</footer></body></html>"


@pytest.mark.parametrize(
    ("body", "text"),
    [
        ("<article><h1>Head &amp; line</h1><p>One  <b>bo</b>ld\n text.<p>Two&nbsp;three.</article>", "Head & line One bold text. Two three."),
        ("<div class='content'><p>Long enough prose to win the vote.</p><div class='ad'>Buy</div></div><div id=sidebar><p>Side</p></div>",
         "Long enough prose to win the vote."),
        ("<article><p>Said.</p></article><section class='comments'><p>I disagree with every single word here.</p></section>", "Said."),
        ("<article><p>a<br>b</p><ul><li>c<li>d</ul><!-- <p>no</p> --><style>p{}</style></article>", "a b c d"),
        ("<main><form><p>Sign up now please</p></form><p>Text 1 &lt; 2.</p></main>", "Text 1 < 2."),
        ("", ""),
        ("<article><p>Open &#x41;&eacute; <a title='a>b'>link</a>", "Open Aé link"),
    ],
)
def test_main_text_of_a_page(body, text):
    assert html_text.Page(page(body)).text(None) == text


@pytest.mark.parametrize(
    "inside",
    [
        "<img alt=Children's src=x>", "<img alt = Children's src='x>y'>", "<div><select><option>No</div>", "<div><object data=x></div>",
        "<div><canvas></div>", "<div><audio></div>", "<div><video><source src=x></div>", "<div><svg><path d='M0'></div>",
        "<div><math></div>", "<div><template></div>", "<img alt=a='b src=x>",
    ],
)
def test_text_after_odd_markup_stays(inside):
    body = f"<article><p>One sentence before it.</p>{inside}<p>We don't lose <b title='a>b'>this</b>, or that.</p></article>"
    assert html_text.Page(page(body)).text(None) == "One sentence before it. We don't lose this, or that."


def test_text_between_an_open_element_and_another_of_its_kind_stays():
    body = "<article><div><svg></div><p>It stays here.</p><svg><path></svg><p>So does this.</p><video><p>No video</p></video></article>"
    assert html_text.Page(page(body)).text(None) == "It stays here. So does this."


LONG = "This is the article, and it says a good deal more than anything around it does. It goes on for a while."


@pytest.mark.parametrize(
    ("body", "text"),
    [
        (f"<div class='post-content no-sidebar'><p>{LONG}</p></div>", LONG),
        (f"<div id='content' class='has-sidebar'><p>{LONG}</p></div>", LONG),
        (f"<div class='entry with-comments'><p>{LONG}</p></div>", LONG),
        (f"<form id='aspnetForm'><div class='x'><p>{LONG}</p></div></form>", LONG),
        (f"<div class='site header-fixed'><div class='content'><p>{LONG}</p></div></div>", LONG),
        (f"<article><p>Be <em class='alert'>very</em> sure. {LONG}</p></article>", f"Be very sure. {LONG}"),
        (f"<article><p>Tick <label>this box</label> first. {LONG}</p></article>", f"Tick this box first. {LONG}"),
        (f"<article><p title='a hidden gem'>{LONG}</p></article>", LONG),
        (f"<article><p>{LONG}</p><span class='social media'>Word</span></article>", f"{LONG} Word"),
        (f"<article><p>{LONG}</p><p hidden>No</p><p style='display: none'>No</p><p aria-hidden=true>No</p></article>", LONG),
        (f"<article><p>{LONG}</p></article><div class='comment-list'><p>Nice one.</p></div><div class='cookie-banner'>We use them.</div>", LONG),
        (f"<article><p>Short.</p></article><section id='comments'><p>{LONG}</p><p>{LONG}</p></section>", "Short."),
        (f"<article><p>{LONG} <span class='ad'>Buy it</span></p><button>Share</button></article>", LONG),
    ],
)
def test_layout_classes_do_not_cost_the_article(body, text):
    assert html_text.Page(page(body)).text(None) == text


@pytest.mark.parametrize(
    "piece", ["<div>", "<b>", "<p><center>", "<svg>", "</p>", "<li><b>", "<td>", "<a ", "</div><form>", "<span></p>", "<div class='c1'>x", "<select>", "<!", "<x a='"]
)
def test_long_broken_pages_take_time_in_proportion(piece):
    def seconds(n):
        start = time.process_time()
        text = html_text.Page("<article><p>It is said.</p>" + piece * n).text(None)
        assert text.startswith("It is said.") or piece.startswith("<div class")
        return time.process_time() - start

    assert min(seconds(20_000) for _ in range(2)) < 2.5


class PlainReader(html.parser.HTMLParser):
    """Text blocks of well-formed pages by the standard library's parser; noise by what the generator used."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.found, self.parts = [], [], []

    def flush(self):
        text = " ".join("".join(self.parts).split())
        if text:
            self.found.append(text)
        self.parts = []

    def handle_starttag(self, tag, attrs):
        if tag not in ("b", "em", "a", "label"):
            self.flush()
        skip = tag in ("nav", "footer", "script", "style", "head", "form", "aside") or dict(attrs).get("class") in ("ad", "comments", "sidebar")
        self.depth.append(bool(self.depth and self.depth[-1]) or skip)

    def handle_endtag(self, tag):
        if tag not in ("b", "em", "a", "label"):
            self.flush()
        self.depth.pop()

    def handle_data(self, data):
        if not self.depth[-1]:
            self.parts.append(data)


@pytest.mark.parametrize("seed", range(40))
def test_generated_pages_against_a_plain_reader(seed):
    rnd = random.Random(seed)
    prose = lambda k: corpus.prose(rnd.randrange(10**6), k)
    layouts = ["<div class='{c}'>{x}</div>", "<main>{x}</main>", "<article class='{c}'>{x}</article>", "<form id='f'><div class='{c}'>{x}</div></form>",
               "<div class='wrap no-sidebar'><section class='{c}'>{x}</section></div>"]
    paragraphs = [f"<p>{prose(30)} <b>{prose(2)}</b> &amp; <label>{prose(3)}</label> {prose(12)}</p>" for _ in range(rnd.randrange(2, 6))]
    paragraphs.insert(1, rnd.choice(["<div class='ad'>Buy now</div>", "<script>var p = '<p>x</p>'</script>", "<ul><li>One point.</li><li>Two points.</li></ul>"]))
    core = rnd.choice(layouts).format(c=rnd.choice(["post", "body-text", "x9", "has-menu"]), x="".join(paragraphs))
    after = rnd.choice(["", f"<section class='comments'><p>{prose(8)}</p></section>", f"<aside><p>{prose(6)}</p></aside>", "<div class='sidebar'><a href='/'>More</a></div>"])
    reader = PlainReader()
    whole = page(core + after)
    reader.feed(whole.replace("<form id='f'>", "<div>").replace("</form>", "</div>").replace("<!DOCTYPE html>", ""))
    reader.flush()
    assert html_text.Page(whole).text(None) == " ".join(reader.found)


def test_host_votes_decide(spark):
    """A page on which another container is larger follows the host's path."""
    usual = [page(f"<div class='a1'><p>{corpus.prose(70 + k, 40)}</p></div><div class='b'><p>Short note here.</p></div>") for k in range(5)]
    odd = page(f"<div class='a7'><p>Brief text.</p></div><div class='b'><p>{corpus.prose(80, 60)}</p></div>")
    table = [(k, "https://H.example.org:80/x", h, "a", "b", "c") for k, h in enumerate([*usual, odd])]
    table += [(9, None, None, None, None, None), (None, "x", "", "", "", ""), (0, "https://h.example.org/y", usual[0], "", "", "")]
    got = html_text.main_text(spark.createDataFrame(table, PAGES))
    found = {(r["page_id"], r["url"]): r for r in got.collect()}
    assert got.count() == len(table)
    assert found[5, "https://H.example.org:80/x"]["text"] == "Brief text." and found[5, "https://H.example.org:80/x"]["path"] == "/html/body/div.a"
    assert found[9, None]["text"] == "" and found[None, "x"]["n_chars"] == 0
    assert found[0, "https://h.example.org/y"]["text"] == found[0, "https://H.example.org:80/x"]["text"]
    assert html_text.main_text(spark.createDataFrame([], PAGES)).count() == 0


def plain_records(table, least):
    def body(row):
        return (row[2] or "").encode()

    out = []
    for row in table:
        same = [r[0] for r in table if body(r) == body(row)]
        top = max((k for k in same if k is not None), default=None)
        visits = len(body(row)) >= least and top is not None and row[0] != top
        digest = base64.b32encode(hashlib.sha1(body(row)).digest()).decode()
        out.append((row[0], len(body(row)), digest, "revisit" if visits else "response", top if visits else None))
    return sorted(out, key=lambda t: [(v is not None, str(type(v)), v) for v in t])


@pytest.mark.parametrize("least", [0, 5])
def test_archives(spark, least):
    html = [page("<p>x</p>"), page("<p>y é漢</p>"), page("<p>x</p>"), "", None, "abc", "abc", "z" * 300_000, page("<p>x</p>")]
    table = [(k, f"http://e.org/{k} b", h, "q", "q", "q") for k, h in enumerate(html)]
    table += [(None, None, "abc", None, None, None), (8, "http://e.org/8", html[8], None, None, None), (None, None, "alone", None, None, None)]
    got = warc.write_and_read(spark.createDataFrame(table, PAGES), min_bytes=least)
    assert rows(got, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == plain_records(table, least)
    assert warc.write_and_read(spark.createDataFrame([], PAGES)).count() == 0


def test_payloads_come_back(spark, tmp_path):
    table = [(k, "http://e.org", f"page {k} é", "", "", "") for k in range(40)]
    frame, folder = spark.createDataFrame(table, PAGES).repartition(3), str(tmp_path / "zip")
    files = spark.createDataFrame(warc.write_archives(frame, folder, archive_bytes=900).collect(), "file string, records long")
    assert files.count() > 3
    got = warc.read_records(spark, files, with_payload=True)
    assert {(r["page_id"], bytes(r["payload"]).decode()) for r in got.collect()} == {(r[0], r[2]) for r in table}
    with zipfile.ZipFile(files.first()["file"]) as archive:
        assert archive.testzip() is None and warc.RECORDS in archive.namelist()


@pytest.mark.parametrize("limit", [None, 40])
def test_zip_directories(limit, monkeypatch):
    """Directories of other writers, comments that hold the end mark, and 64-bit fields (forced by a low limit)."""
    data = {"a.bin": b"A" * 30, "dir/b.txt": b"hello" * 50}
    if limit is None:
        sink = io.BytesIO()
        with zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED) as archive:
            for name, content in data.items():
                with archive.open(name, "w", force_zip64=True) as member:
                    member.write(content)
            archive.writestr("deflated", "x" * 100, zipfile.ZIP_DEFLATED)
            archive.comment = b"PK\x05\x06 not the end"
    else:
        monkeypatch.setattr(warc, "_MAX32", limit)
        sink = io.BytesIO()
        writer = warc.ZipWriter(sink)
        for name, content in data.items():
            writer.add(name, iter([content]), len(content), 0)
        writer.close()
    raw = sink.getvalue()
    members = warc.zip_members(lambda at, size: raw[at : at + size], len(raw))
    assert {n: raw[a : a + k] for n, (a, k) in members.items()} == data


LOG = "conv_id long, turn long, role string, text string, c string, position long"


def test_chats(spark):
    base = [("user", "hi"), ("assistant", "hello"), ("user", "more"), ("assistant", None)]
    table = [(9, k, *t) for k, t in enumerate(base)] + [(1, 10 * k, *t) for k, t in enumerate(base[:2])] + [(2, k, *t) for k, t in enumerate(base[:3])]
    table += [(3, k, *t) for k, t in enumerate(base)] + [(4, 0, "user", "hi"), (4, 1, "assistant", "other"), (5, None, " USER ", "hi"), (6, 0, None, None)]
    table += [(None, 0, "system", "s"), (None, 1, "", "t"), (4, 1, "assistant", "other")]
    log = spark.createDataFrame([(*r, "x", 5) for r in table], LOG)
    got = rows(chat_format.format_chats(log, block=3), "conv_id", "part", "n_turns", "n_copies", "text")

    def shown(*turns):
        return "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in turns)

    assert got == [
        (None, 0, 2, 1, shown(("system", "s"), ("user", "t"))),
        (3, 0, 4, 2, shown(("user", "hi"), ("assistant", "hello"), ("user", "more"))),
        (3, 1, 4, 2, shown(("assistant", ""))),
        (4, 0, 2, 1, shown(("user", "hi"), ("assistant", "other"))),
        (6, 0, 1, 1, shown(("user", ""))),
    ]
    assert chat_format.format_chats(spark.createDataFrame([], LOG)).count() == 0


def test_chats_do_not_depend_on_blocks(spark):
    table = [(k, t, "user", f"{t % 3}", "x", 0) for k in range(4) for t in range(5 + 2 * k)]
    log = spark.createDataFrame(table, LOG)
    for block in (2, 1024):
        assert {(r["conv_id"], r["n_turns"]) for r in chat_format.format_chats(log, block=block).collect()} == {(3, 11)}


def test_a_hot_conversation_spreads_over_ranges(spark, monkeypatch):
    """Rows of a null id with one turn number are a third of all; no range holds them, and the order is kept."""
    whole, spread = chat_format.materialise, {}

    def spied(frame, name):
        done = whole(frame, name)
        if name == "turn-order":
            spread.update({r[0]: r[1] for r in done.filter("c.id is null").selectExpr("shiftright(place, 33) as r").groupBy("r").count().collect()})
        return done

    monkeypatch.setattr(chat_format, "materialise", spied)
    hot = spark.range(3000).selectExpr("cast(null as long) as conv_id", "cast(null as long) as turn", "'user' as role", "concat(md5(cast(id as string)), repeat('x', 50)) as text")
    rest = spark.range(6000).selectExpr("id % 500 as conv_id", "id as turn", "'user' as role", "cast(id as string) as text")
    long = spark.range(1).selectExpr("cast(900 as long) as conv_id", "cast(0 as long) as turn", "'user' as role", "repeat('long ', 400000) as text")
    turns = chat_format.numbered_turns(hot.union(rest).union(long))
    places = turns.filter("c.id is null").select("position", "text").collect()
    texts = [r["text"] for r in sorted(places, key=lambda r: r["position"])]
    assert [r for r in sorted(r["position"] for r in places)] == list(range(1, 3001)) and texts == sorted(texts)
    assert len(spread) > 1 and max(spread.values()) < 2800
    assert chat_format.format_chats(long).first()["text"] == "<|im_start|>user\n" + "long " * 400000 + "<|im_end|>\n"


def test_quality_votes(spark):
    good = [(k, corpus.prose(200 + k, 80)) for k in range(60)]
    bad = [(100 + k, " ".join(w + "###" for w in corpus.prose(300 + k, 80).split(" "))) for k in range(60)]
    rest = [(500, None), (501, ""), (None, corpus.prose(1, 90)), (0, good[0][1])]
    docs = corpus.table(spark, [(*r, *["z"] * 2, 1, *["q"] * 5) for r in [*good, *bad, *rest]])
    given = [(k, int(k < 100), 0) for k, _ in [*good, *bad]] + [(0, 1, 0), (None, 1, 0)]
    labels = spark.createDataFrame(given, "doc_id long, quality int, toxic int")
    found = quality_knn.score_quality(docs, labels).collect()
    assert len(found) == docs.count()
    for row in found:
        key = row["doc_id"]
        if key is None or key < 500:
            assert row["predicted"] == int(key is None or key < 100)
            assert row["held_out"] == (key is None or __import__("zlib").crc32(str(key).encode()) % 4 == 2)
        else:
            assert row["score"] == 0 and row["predicted"] == 0
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in quality_knn.score_quality(docs, none).collect()} == {0.5}
    assert quality_knn.score_quality(corpus.table(spark, []), labels).count() == 0


def test_scores_do_not_depend_on_held_out_labels(spark):
    docs = corpus.table(spark, [(k, corpus.prose(k, 30 + k), *[None] * 8) for k in range(40)])
    known = [(k, k % 2, 0) for k in range(40)]
    import zlib

    flipped = [(k, 1 - q if zlib.crc32(str(k).encode()) % 4 == 2 else q, t) for k, q, t in known]
    scores = [
        rows(quality_knn.score_quality(docs, spark.createDataFrame(x, "doc_id long, quality int, toxic int"))) for x in (known, flipped)
    ]
    assert scores[0] == scores[1] and known != flipped
