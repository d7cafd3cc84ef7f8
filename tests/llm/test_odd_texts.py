"""Pages and texts whose shape once cost time by the square of their length, or whose parts were lost."""

import time

import pytest
from pyspark.sql import functions as F

from quadspark.llm import extract, pii, scratch

SIZE = 1_000_000
PAGES = {
    "tags that never end": "<a " * (SIZE // 3),
    "an open quote in each tag": '<a x=">t</a> ' * (SIZE // 13),
    "quotes of two kinds": "<a b=\"'>x" * (SIZE // 10),
    "stray end tags": "<div>" * 20_000 + "</span></b>" * (SIZE // 12),
    "deep elements": "<div>" * (SIZE // 12) + "x" + "</div>" * (SIZE // 13),
    "inline elements that stay open": "<b>" * (SIZE // 6) + "<div>x</div>" * (SIZE // 24),
    "brackets alone": "< " * (SIZE // 2),
}


@pytest.mark.parametrize("name", PAGES)
def test_malformed_pages_take_time_by_their_length(name):
    start = time.process_time()
    extract.main_text(PAGES[name])
    assert time.process_time() - start < 12  # some seconds at most; by the square it would be hours


@pytest.mark.parametrize("page", ['<p title="a > b">x, y.</p>', "<p a='\"'>one</p><p b=\">\">two</p>", '<p a="x>one "two" three</p>', "<i<b>x", "<p a=b'c>x</p>", 'a < b <p class="c">d</p', "<a href=x/>y"])
def test_tags_end_at_the_first_bracket_outside_quotes(page):
    ends = extract._Ends(page)
    for m in extract._OPEN.finditer(page):
        if m[3]:
            quote, at = "", m.end()
            while at < len(page) and (quote or page[at] != ">"):
                quote = "" if page[at] == quote else quote or (page[at] if page[at] in "\"'" else "")
                at += 1
            want = at + 1 if at < len(page) else page.find(">", m.end()) + 1 or -1
            assert ends.after(m.end()) == want


def test_marked_blocks_dont_pull_their_neighbours_along():
    article = "ninety characters of an article without any punctuation mark in it that a page may well have"
    page = f'<div class="container"><p>{article}</p><div class="notice-box">Notice: x</div><p class="text-muted">Short end</p></div>'
    assert extract.main_text(page) == f"{article}\n\nShort end"
    for mark in ("user-reviews", "cc-window", "tt-legal", "site-copyright"):
        assert extract.main_text(f'<div class="container"><p>{article}, so.</p><div class="{mark}"><p>Great stuff, would read again.</p></div></div>') == f"{article}, so."


DOCS = "doc_id long, text string"


def test_whole_entities_of_any_length_and_script(spark):
    long = "aB3_" * 60_000
    texts = [f"password: {long} end", "mail müller@firma.de now", "mail élodie.çelik@exämple.fr.", "пишите иван@почта.рф сюда", "call 020 7946 0958 today", "mail plain.name@site.com ok", "a müller @ b"]
    start = time.process_time()
    got = {r.doc_id: r for r in pii.pseudonymise(spark.createDataFrame(list(enumerate(texts)), DOCS)).collect()}
    assert "aB3_" * 8 not in got[0].text and got[0].text.startswith("password: ") and got[0].text.endswith(" end") and len(got[0].text) > len(long)
    assert [got[i].n_entities for i in range(7)] == [1, 1, 1, 1, 1, 1, 0] and got[6].text == texts[6]
    for i, gone in ((1, ("ü", "firma", "ller")), (2, ("ç", "lodie", "ä")), (3, ("иван", "почта")), (4, ("7946", "0958")), (5, ("plain", "site"))):
        assert not any(g in got[i].text for g in gone), got[i].text
    assert "@" in got[3].text and all("а" <= c <= "я" for c in got[3].text.split()[1].split("@")[0])
    assert time.process_time() - start < 60


def test_only_clashing_surrogates_are_drawn_again(spark, monkeypatch):
    sizes, write = [], scratch.write
    monkeypatch.setattr(scratch, "write", lambda df, kind="table": (out := write(df, kind), sizes.append((kind, out.count())))[0])
    entities = spark.range(3000).select(F.lit("ip").alias("kind"), F.concat(F.lit("10.0."), (F.col("id") / 250).cast("int").cast("string"), F.lit("."), (F.col("id") % 250).cast("string")).alias("norm"))
    extra = spark.range(60).select(F.lit("email").alias("kind"), F.concat(F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), (F.col("id") % 26 + 1).cast("int"), F.lit(1)), F.lit("@x"), F.col("id").cast("string"), F.lit(".com")).alias("norm"))
    made = pii.assign(entities.unionByName(extra)).collect()
    assert len(made) == len({(r.kind, r.made) for r in made}) == 3060 and not {r.made for r in made} & {r.norm for r in made}
    drawn = [n for kind, n in sizes if kind == "surrogates"]
    assert drawn[0] == 3060 and all(n < 100 for n in drawn[1:])
