"""Pages: main text and archives."""

import hashlib

import pytest
from pyspark.sql import functions as F

from shelfsync.llm import html_text, warc_archive

LONG = "The house on the hill was the home of a man who had been in the war and who did not like to talk about it at all."
KIND = "page_id long, url string, html string"


def test_article_is_found_without_its_surroundings():
    page = f"""<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body class="home">
    <header><h1>Site</h1><nav><ul><li><a href="/">Home</a></li></ul></nav></header><!-- <p>{LONG}</p> -->
    <div class="ad">{LONG}</div><div id="content-with-sidebar"><article class="post comments-open"><header class="entry-header"><h2>A  title &amp; more</h2></header>
    <p>{LONG}<p><b>Second</b>&nbsp;one<br>goes on.</p><p><a href="x">only a long list of links that stands here for its own sake</a></p>
    <form><p>{LONG}</p></form></article></div><aside><p>{LONG}</p></aside><div class="reader comments"><p>{LONG}</p></div>
    <div style="display:none">{LONG}</div><footer>&copy; us</footer></body></html>"""
    assert html_text.main_text(page) == f"A title & more\n{LONG}\nSecond one goes on."


def test_pages_without_an_article_go_by_density():
    page = f"<div><a href='/'>Home</a> <a href='/b'>About</a></div><h1>Title</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p><div>Xyz Qrs Tuv Wxy 123 456 Xyz Qrs Tuv Wxy 123 456 Xyz Qrs Tuv Wxy 123 456 Zz</div>"
    assert html_text.main_text(page) == f"Title\n{LONG}\nShort.\n{LONG}"


def test_undecided_blocks_follow_the_nearest_decided_one():
    bad = "<div><a href='/'>" + "link text " * 12 + "</a></div>"
    assert html_text.main_text(f"<p>{LONG}</p><p>near the text</p>{bad}<p>near the links</p>{bad}") == f"{LONG}\nnear the text"


def test_text_outside_of_a_teaser_article_is_kept():
    teaser = "<article><h3>A card</h3><p>Read on.</p></article>"
    assert html_text.main_text(f"{teaser}<div><p>{LONG}</p><p>In between.</p><p>{LONG}</p></div>") == f"A card\nRead on.\n{LONG}\nIn between.\n{LONG}"


def test_pages_of_an_unknown_language_go_by_links_and_length():
    text = "Talo seisoi mäen päällä ja siinä asui vanha mies, joka oli ollut sodassa eikä halunnut puhua siitä kenellekään."
    page = f"<div><a href='/'>{'linkki toinen ' * 8}</a></div><h1>Otsikko</h1><p>{text}</p><p>Lyhyt.</p><p>{text}</p>"
    assert html_text.main_text(page) == f"Otsikko\n{text}\nLyhyt.\n{text}"


def test_undecided_blocks_of_an_article_follow_their_neighbours():
    bad = "<div><a href='/'>" + "link text " * 12 + "</a></div>"
    dense = "Xyz Qrs Tuv Wxy 123 456 Xyz Qrs Tuv Wxy 123 456 Xyz Qrs Tuv Wxy 123 456 Zz"
    assert html_text.main_text(f"<article><p>{LONG}</p><p>near the text</p>{bad}<p>near the links</p>{bad}<p>{dense}</p></article>") == f"{LONG}\nnear the text"


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<p", "<!--", "<script>", "&", "<p>" * 500])
def test_broken_pages(page):
    assert isinstance(html_text.main_text(page), str)


def test_extract_keeps_every_row(spark):
    rows = [(1, "u", f"<article><p>{LONG} ü😀</p></article>"), (1, "u", f"<article><p>{LONG} ü😀</p></article>"), (2, None, None), (None, "v", ""), (3, "w", "<article>" + f"<p>{LONG}</p>" * 3000 + "</article>")]
    df = spark.createDataFrame(rows, KIND).withColumn("text", F.lit("clash")).withColumn("n_chars", F.lit("clash"))
    got = sorted(((r["page_id"] or 0, r["url"], r["text"], r["n_chars"]) for r in html_text.extract(df).collect()), key=str)
    text = f"{LONG} ü😀"
    assert got == sorted([(0, "v", "", 0), (1, "u", text, len(text)), (1, "u", text, len(text)), (2, None, "", 0), (3, "w", "\n".join([LONG] * 3000), 3000 * len(LONG) + 2999)], key=str)
    assert html_text.extract(df.limit(0)).count() == 0


def brute_records(rows):
    first = {}
    for i, _, h in rows:
        data = (h or "").encode()
        if len(data) >= 100 and i is not None:
            first[data] = min(first.get(data, i), i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        to = first.get(data)
        to = to if i is not None and to != i else None
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


PAGES = [(5, "http://a", "x" * 200), (3, "http://b", "x" * 200), (9, None, "x" * 200), (4, "c d\r\nX: y", "short"), (6, "", "short"), (7, "ü", None), (8, "u", "é" * 70), (1, "u", "é" * 70),
         (None, "n", "x" * 200), (3, "http://b", "x" * 200), (10, "big", "abc " * 500_000)]


def test_archives_round_trip(spark, tmp_path):
    df = spark.createDataFrame(PAGES, KIND).withColumn("digest", F.lit(1)).withColumn("payload", F.lit(2))
    got = [tuple(r[n] for n in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in warc_archive.round_trip(df).collect()]
    assert sorted(got, key=str) == brute_records(PAGES)
    folder = str(tmp_path / "warc")
    written = warc_archive.write(df, folder)
    back = warc_archive.read(spark, folder, written).collect()
    assert sorted((r["url"] or "") for r in back) == sorted((p[1] or "") for p in PAGES)
    assert all(hashlib.sha256(bytes(r["payload"])).hexdigest() == r["payload_digest"] for r in back if r["record_type"] == "response")
    assert warc_archive.round_trip(df.limit(0)).count() == 0


def test_damage_is_noticed():
    records = [warc_archive.record(i, f"http://x/{i}", b"payload %d" % i, None, hashlib.sha256(b"payload %d" % i).hexdigest()) for i in range(40)]
    archive = warc_archive.packed(records)
    assert list(warc_archive.unpacked(archive)) == records
    for bad in (b"", archive[:6], archive[1:], archive[:-3], archive + b"junk"):
        with pytest.raises(warc_archive.Damaged):
            list(warc_archive.unpacked(bad))
    good = records[0]
    for old, new in ((b"Content-Length: 9\r\n", b"Content-Length: 8\r\n"), (b"WARC/1.1", b"WARX/1.1"), (b"payload 0", b"payload 1"), (b"WARC-Type: response", b"WARC-Type: other"), (b"\r\n\r\nHTTP", b"\r\n\r\n\r\nHTTP")):
        assert old in good
        with pytest.raises(warc_archive.Damaged):
            warc_archive.parsed(good.replace(old, new, 1))
    assert warc_archive.parsed(good)["page_id"] == 0
