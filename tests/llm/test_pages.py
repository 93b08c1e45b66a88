import base64
import hashlib
import os
import time

import pytest

from swipeflow.llm import html_blocks, warc
from tests.conftest import SF_SMALL
from tests.llm.conftest import clashing

TREE = html_blocks.grow(*html_blocks.training_table())


def text(page):
    return html_blocks.main_text(page, TREE)


def test_tree_learns_its_table():
    x, y = html_blocks.training_table()
    assert (TREE.decide(x) == y).mean() > 0.98


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, ""),
        ("", ""),
        ("<!-- only <p>a comment</p>", ""),
        ("<p>A plain paragraph &amp; an entity&nbsp;&lt;b&gt;, with\n\n  white   space.", "A plain paragraph & an entity <b>, with white space."),
        ("<article><h1>T</h1><p>One.<p>Two <b>bold<br>line</article><footer>Made here.</footer>", "T\n\nOne.\n\nTwo bold line"),
        ('<article><p>Before <script>var t="</p><p>no";</script>after.</p><style>p{}</style></article>', "Before after."),
        ("<article><p>Text.</p></article><div class='comments'><article><p>First! I was here first.</p></article></div>", "Text."),
        ("<div id=cookie-banner>We use cookies to follow you around the web.</div><article><p>Text.</p></article>", "Text."),
        ("<article><p>Text.</p><div class=ad>Buy a thing that nobody needs at all today.</div><p>More.</p></article>", "Text.\n\nMore."),
        ("<nav><a href=/>Home</a></nav><main><p>Text &copy; here.</p><form><p>Your name and your address, please.</p></form></main><aside><p>See also other things.</p></aside>", "Text © here."),
        ("<main><p hidden>not seen at all</p><p>Seen.</p><ul><li>a<li>b</ul></main>", "Seen.\n\na\n\nb"),
        ("<article><p>It is 1 < 2 and 3 > 2.</p></article>", "It is 1 < 2 and 3 > 2."),
        ("<article><p title='a>b'>Quoted.</p><p title='x>Unclosed.</p></article>", "Quoted.\n\nUnclosed."),
    ],
)
def test_main_text(page, want):
    assert text(page) == want


@pytest.mark.parametrize("part", ["<a ", '<a ">" ', "<a '>' \">\" ", "<svg>", "<div>", "<span>", "<!--", "<", "<a \"'>", "<script>", "&lt;", "<a href=x>", '<a "<b \''])
def test_broken_pages_of_a_megabyte_take_linear_time(part):
    page = "<article><p>Words of the article, in one sentence.</p>" + part * (1_000_000 // len(part))
    began = time.monotonic()
    assert "Words of the article" in html_blocks.blocks_of(page)[0].text
    assert time.monotonic() - began < 20
    assert len(text("<article>" + "<p>word " * 20000)) > 90000


def test_end_tags_find_their_element_however_deep():
    body = "<article><p>" + "This is the article that people came to read. " * 4 + "</p></article>"
    for depth in (150, 205, 5000):
        page = "<nav>" + "<div>" * depth + "<a href=x>Menu</a></nav>" + body
        assert text(page).startswith("This is the article") and "Menu" not in text(page)


def test_links_around_blocks_are_linked():
    blocks = html_blocks.blocks_of("<a href=x><div>eight words that a link holds all together</div></a><p>free words</p>")
    assert [(b.words, b.linked) for b in blocks] == [(8, 8), (2, 0)]
    # a link that is never closed ends with its block
    blocks = html_blocks.blocks_of("<p><a href=x>one two<p>three four <a href=y>five</a>")
    assert [(b.words, b.linked) for b in blocks] == [(2, 2), (3, 1)]


def test_extract_over_a_table(session):
    pages = session.createDataFrame([(1, "u", "<article><p>Hi you.</p></article>"), (2, None, None), (1, "u", ""), (None, "v", "<p>")], "page_id long, url string, html string")
    got = sorted(html_blocks.extract(clashing(pages)).collect(), key=str)
    assert len(got) == 4 and {r["text"] for r in got} == {"Hi you.", ""} and all(r["n_chars"] == len(r["text"]) for r in got)
    assert html_blocks.extract(pages.limit(0)).count() == 0


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def test_warc_round_trip_rolls_and_is_deterministic(session, tmp_dir):
    rows = [(i, f"http://h/{i}", f"<p>{i % 7} é漢</p>" * (i % 5)) for i in range(60)] + [(100, None, None), (101, "a\r\nb: c", "x" * 300000), (None, "n", "dup"), (5, "again", "dup"), (102, "m", "dup"), (5, "again", "dup")]
    pages = session.createDataFrame(rows, "page_id long, url string, html string")
    hashes = []
    for k in range(2):
        folder = f"{tmp_dir}/w{k}"
        manifest = warc.write_warc(clashing(pages) if k else pages.repartition(3), folder, roll=1000)
        hashes.append({r["sha256"] for r in manifest.collect()})
        assert manifest.count() > 1 and not [f for f in os.listdir(f"{folder}/_temporary") if "warc" in f]
    got = sorted(warc.read_warc(session, folder).collect(), key=lambda r: str((r["page_id"], r["url"], r["payload_digest"])))
    want = []
    for page, url, html in rows:
        first = min((p for p, _, h in rows if (h or "") == (html or "") and p is not None), default=None)
        revisit = page is not None and page != first
        want.append((page, url if url is None else url.replace("\r", "%0D").replace("\n", "%0A"), len((html or "").encode()), digest(html), "revisit" if revisit else "response", first if revisit else None, None if revisit else (html or "").encode()))
    want.sort(key=lambda r: str((r[0], r[1], r[3])))
    assert [tuple(r) for r in got] == want
    assert warc.read_warc(session, f"{tmp_dir}/w0").count() == len(rows)


def test_warc_files_repeat_byte_for_byte(session, tmp_dir):
    pages = session.read.parquet(f"{SF_SMALL}/pages.parquet")
    names = []
    for k in range(2):
        manifest = warc.write_warc(pages, f"{tmp_dir}/{k}", roll=20000)
        names.append(sorted((r["file"], r["sha256"]) for r in manifest.collect()))
    assert names[0] == names[1]
    for name, sha in names[0]:
        with open(f"{tmp_dir}/0/{name}", "rb") as f:
            assert hashlib.sha256(f.read()).hexdigest() == sha


def test_warc_of_an_empty_table_and_small_payloads(session, tmp_dir):
    pages = session.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    warc.write_warc(pages, f"{tmp_dir}/m", min_revisit=3)
    kinds = {r["page_id"]: r["record_type"] for r in warc.read_warc(session, f"{tmp_dir}/m").collect()}
    assert kinds == {1: "response", 2: "response", 3: "response", 4: "revisit"}
    warc.write_warc(pages.limit(0), f"{tmp_dir}/e")
    assert warc.read_warc(session, f"{tmp_dir}/e").count() == 0


@pytest.mark.parametrize("hot", [3, 10**9])
def test_repeated_rows_are_split_and_keep_their_revisits(session, tmp_dir, monkeypatch, hot):
    monkeypatch.setattr(warc, "HOT_ROWS", hot)
    rows = [(7, "u", "same")] * 900 + [(3, "first", "same"), (None, "n", "same"), (8, None, "same")] + [(9, f"u{k % 5}", "other") for k in range(600)] + [(None, "n", "other")] * 400
    pages = session.createDataFrame(rows, "page_id long, url string, html string").repartition(8)
    session.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = warc.write_warc(pages, f"{tmp_dir}/h", roll=200)
    finally:
        session.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = sorted(((r["page_id"], r["url"], r["record_type"], r["refers_to"]) for r in warc.read_warc(session, f"{tmp_dir}/h").collect()), key=str)
    want = [(p, u, "revisit", 3) if p in (7, 8) else (p, u, "response", None) for p, u, _ in rows]
    assert got == sorted(want, key=str)
    per_task = {}
    for r in manifest.collect():
        per_task[r["file"].split("-")[1]] = per_task.get(r["file"].split("-")[1], 0) + r["records"]
    if hot == 3:  # no task has most of the rows of one page
        assert max(per_task.values()) < 900


def test_damaged_files_are_refused(session, tmp_dir):
    pages = session.createDataFrame([(1, "u", "abc")], "page_id long, url string, html string")
    name = warc.write_warc(pages, f"{tmp_dir}/d").first()["file"]
    record = warc.gzip_member(warc.record_bytes(1, "u", b"abc", digest("abd"), 3, None, warc.EPOCH))
    with open(f"{tmp_dir}/d/{name}", "wb") as f:
        f.write(record)
    with pytest.raises(Exception, match="payload digest"):
        warc.read_warc(session, f"{tmp_dir}/d").collect()
