"""Page extraction and chat formatting."""

import html
import itertools
import os
import re

import numpy as np
import pytest
from pyspark.sql import types as T

from fraudlens.llm import op4_html_text as web
from fraudlens.llm import op7_chat_format as chat
from fraudlens.llm.common import table

SF = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
STORY = ["The river rose for three days before the bridge gave way, and nobody in the lower town slept.",
         "On the fourth morning the water fell as fast as it had come &amp; left the fields under mud.",
         "Short one.", "Then the long work of clearing began, street by street, with borrowed tools."]
GOLD = " ".join(html.unescape(s) for s in STORY)
BODY = "".join(f"<p>{s}" for s in STORY)


def test_marked_article():
    page = ("<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header>Site</header>"
            "<nav><ul><li><a href='/a'>Home</a></li></ul></nav><!-- x > --><div class='ad top'><div>Buy</div> now</div>"
            f"<main><article>{BODY}<div id='comments'><p>I liked it</p></div><form><input>Mail</form>"
            "<script>var t='</p><p>no';</script></article></main><footer>Bye</footer></body></html>")
    assert web.main_text(page) == GOLD


@pytest.mark.parametrize("menu", [3, 30])
def test_unmarked_page_by_surge_and_dive(menu):
    links = "".join(f"<li><a href='/{i}'>Menu entry {i}</a></li>" for i in range(menu))
    page = (f"<html><body><table><tr><td>{links}</td></tr></table><div>Today</div><div>Sunny</div><hr><hr><hr>"
            f"<div><h1>Flood</h1>{BODY}</div><hr><hr><hr><div>Tel. 555</div><div>Imprint</div>{links}")
    assert web.main_text(page) == "Flood " + GOLD


@pytest.mark.parametrize("before,after", [
    ("<div class='page has-sidebar'><article>", "</article></div>"),
    ("<div class='layout no-comments'><main>", "</main></div>"),
    ("<form action='/x'><article>", "</article></form>"),
    ("<nav><a href='/'>Home</a><article>", "</article>"), ("<div>Logo</div><nav>Menu<main>", "</main>"),
    ("<div class='social-policy-article'>", "</div>"), ("<a name=top><div>", "</div>"),
    ("<article><p class='notice-of-claim'>", "</article>"),
    ("<ul><li><a href='/a'>menu a</a></ul><div>", "</div><ul><li><a href='/b'>menu b</a><li><a href='/c'>c</a></ul>"),
    ("<aside class=related><article>Teaser one</article></aside><div>", "</div>"),
    ("<div>", "</div><div id=comments><article class=comment>" + "What a story that was, I say. " * 20 + "</article>")])
def test_article_survives_its_surroundings(before, after):
    page = f"<html><body>{before}{BODY}{after}"
    assert web.main_text(page) == GOLD


def test_sections_of_an_unmarked_page():
    long = "<p>" + "The first part goes on about the flood for very many words. " * 40
    late = "<p>A last section is much shorter than that, but it belongs to the article all the same, says all."
    menu = "".join(f"<li><a href='/{i}'>Entry {i}</a>" for i in range(3))
    page = (f"<div>{long}</div><ul>{menu}</ul><div>{late}</div><div><a href='/x'>See also</a></div>{late}"
            "<hr><hr><hr><div>Tel. 5</div>")
    got = web.main_text(page)
    assert got.startswith("The first part") and "Entry" not in got                  # a window of links: no text
    assert got.count("says all.") == 2 and " See also " in got and got.endswith("says all.")


def windows_by_definition(lengths):
    """The kept lines from the definition, window by window."""
    n = len(lengths)
    surge = [i for i in range(n) if lengths[i] and any(
        s <= i < s + web.WINDOW and sum(lengths[s:s + web.WINDOW]) >= web.SURGE for s in range(n))]
    if not surge:
        return [x > 0 for x in lengths]
    dead = {i for s in range(n - web.WINDOW + 1) if not any(lengths[s:s + web.WINDOW]) for i in range(s, s + web.WINDOW)}
    return [surge[0] <= i <= surge[-1] and i not in dead for i in range(n)]


def test_windows_against_definition():
    rng = np.random.default_rng(3)
    for _ in range(400):
        lengths = rng.choice([0, 0, 0, 10, 30, 79, 200], size=int(rng.integers(0, 25)))
        assert web.between(lengths).tolist() == windows_by_definition(lengths.tolist())


LINKS = "<ul>" + "".join(f"<li><a href='/{i}'>Entry {i}</a>" for i in range(4)) + "</ul>"


@pytest.mark.parametrize("page,text", [
    (f"<main><h1>Flood</h1>{LINKS}<p>By me<p>Today{BODY}<p>The end.</p>{LINKS}<p>Tel. 555</main>",
     f"Flood By me Today {GOLD} The end."),                                          # from dive to dive, and headings
    (f"<article>{BODY}{LINKS}{BODY}</article>", f"{GOLD} {GOLD}"),                   # a window of links
    (f"<div>{BODY}</div><article><h2>More</h2><p>Teaser</article>", f"{GOLD} More Teaser"),  # the mark is on a teaser
    (f"<article><p>Brief news.</article><div>{BODY}</div>", f"Brief news. {GOLD}"),
    (f"<article>{BODY}<p>Read <a href='/x'>this{BODY}{BODY}</article>", f"{GOLD} Read this {GOLD} {GOLD}"),
    ("<article><p>Brief news.</article><div>Imprint</div>", "Brief news."),
    (f"<article>{LINKS}</article>", "Entry 0 Entry 1 Entry 2 Entry 3")])
def test_windows_decide_in_marked_articles(page, text):
    assert web.main_text(page) == text


def marked_by_definition(lengths):
    """The kept lines of a marked article, window by window."""
    n = len(lengths)
    if not any(lengths):
        return [True] * n
    surge = [i for i in range(n) if lengths[i] and any(
        s <= i < s + web.WINDOW and sum(lengths[s:s + web.WINDOW]) >= web.SURGE for s in range(n))]
    dead = {i for s in range(n - web.WINDOW + 1) if not any(lengths[s:s + web.WINDOW]) for i in range(s, s + web.WINDOW)}
    first = max([i for i in dead if surge and i < surge[0]], default=-1)
    last = min([i for i in dead if surge and i > surge[-1]], default=n)
    return [first < i < last and i not in dead for i in range(n)]


def test_article_windows_against_definition():
    rng = np.random.default_rng(4)
    for _ in range(400):
        lengths = rng.choice([0, 0, 0, 0, 10, 30, 79, 200], size=int(rng.integers(0, 25)))
        assert web.dive_to_dive(lengths).tolist() == marked_by_definition(lengths.tolist())


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("  \n", ""), ("just text &eacute;&nbsp;here", "just text é here"),
    ("<p>a<b>b</b>c <br>d</p><p>e", "abc d e"), ("<article><p>x &am", "x &am"), ("<p class=ad>Buy<p>Read", "Read"),
    ("<nav>never closed <p>gone", ""), ("a < b and <3", "a < b and <3"), ("<div class='ad'><div>x</div>y</div>z", "z"),
    ("<script>if (a</b/) {}</script><p title='a > b'>k</p>", "k"), ("<article></article><p>out", "out"),
    ("<p class='readable'>kept</p><p class='shadow'>too</p>", "kept too")])
def test_small_pages(page, text):
    assert web.main_text(page) == text


def test_long_and_hostile_pages():
    assert web.main_text("<article>" + "<p>word word</p>" * 20_000) == " ".join(["word word"] * 20_000)
    assert web.main_text("<p>" + "<b" * 3_000 + " tail").startswith("") and web.main_text("<" * 5_000) == "<" * 5_000
    assert web.main_text("<article><p>" + "<div>" * 5_000 + "deep") == "deep"


@needs_data
def test_given_pages_exact(spark):
    pages = table(spark, SF, "pages").toPandas().set_index("page_id")
    got = web.query(spark, SF).toPandas()
    assert len(got) == len(pages)
    for r in got.itertuples():
        article = re.search("<article>(.*?)</article>", pages["html"][r.page_id], re.S)[1]
        want = " ".join(html.unescape(re.sub("</?(?:p|b|br|h1)>", " ", article)).split())
        assert r.text == want and r.n_chars == len(want)


def test_page_tables(spark):
    schema = "page_id long, url string, html string, text string, n_chars string"
    assert web.extract(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, None, "<p>a", "old", "x")] * 2 + [(None, "u", None, None, None)]
    got = web.extract(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.text, r.n_chars) for r in got) == [("", 0), ("a", 1), ("a", 1)]


# -- chats ----------------------------------------------------------------------
def model():
    rng = np.random.default_rng(1)
    starts = {s: int(rng.integers(0, 20)) for s in chat.STATES}
    moves = {(a, b): int(rng.integers(0, 20)) for a in chat.STATES for b in chat.STATES}
    seen = {(f, s, v): int(rng.integers(0, 9)) for f in chat.FEATURES for s in chat.STATES
            for v in ("", "user", "system", "assistant", "True", "False", "0", "1", "?", ".")}
    return chat.Model(starts, moves, seen)


def test_viterbi_equals_enumeration():
    m = model()
    rng = np.random.default_rng(2)
    for n in range(1, 6):
        observed = [(str(rng.choice(["", "user", "system"])), bool(rng.integers(2)), i == 0, int(rng.integers(2)),
                     str(rng.choice(["", "?", "."]))) for i in range(n)]
        e = [m.emission(o) for o in observed]

        def worth(path):
            return m.start[path[0]] + e[0][path[0]] + sum(m.move[a, b] + e[i + 1][b]
                                                          for i, (a, b) in enumerate(zip(path, path[1:])))
        best = max(itertools.product(range(m.n), repeat=n), key=worth)
        assert abs(worth(tuple(m.viterbi(observed))) - worth(best)) < 1e-9


@needs_data
def test_roles_of_held_out_conversations(spark):
    got = chat.query(spark, "/root/testdata/sf0.1").toPandas()
    assert len(got) == 1_000 and got[got["held_out"]]["roles_match"].mean() > 0.95
    one = got[got["roles_match"]].iloc[0]
    assert one["rendered"].count("<|im_start|>") == one["n_turns"] == one["rendered"].count("<|im_end|>")


SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                       T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])


def test_chat_edge_cases(spark):
    talk = [(c, t, "user" if t % 2 == 0 else "assistant", f"Is this line {t} ok?" if t % 2 == 0 else f"Yes {t}.\nSure.")
            for c in range(40) for t in range(6)]
    rows = spark.createDataFrame(talk + talk[:7], SCHEMA)
    found = chat.transcripts(rows)
    assert found.count() == 40
    m = chat.learn(found)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "\n \n"), (4, "User: hi\nAssistant: yes\nmore\nUser: bye"),
                                 (5, "word " * 50_000), (6, "line\n" * 5_000)],
                                "id long, text string")
    got = {r.id: r for r in chat.format_chats(odd.selectExpr("*", "1 as turns", "2 as ts"), m).collect()}
    assert [got[i].n_turns for i in (1, 2, 3)] == [0, 0, 0] and got[1].rendered == ""
    assert [(t.role, t.text) for t in got[4].turns] == [("user", "hi"), ("assistant", "yes\nmore"), ("user", "bye")]
    assert got[5].n_turns == 1 and got[6].n_turns >= 1
    assert got[4].rendered.startswith("<|im_start|>user\nhi<|im_end|>\n")


class Fixed(chat.Model):
    """Takes the states as given."""
    def __init__(self, states):
        self.states = [chat.STATES.index(s) for s in states]

    def viterbi(self, observed):
        return self.states


def test_lines_inside_a_turn_stay():
    ask, more, reply = ("user", True), ("user", False), ("assistant", True)
    text = "User: What is\n\n \nAnswer: 42 for?\nA\n  indented\n\nAI: Nobody knows.\n"
    got = Fixed([ask, more, more, more, reply]).turns(text)
    assert got == [{"role": "user", "text": "What is\n\n \nAnswer: 42 for?\nA\n  indented"},
                   {"role": "assistant", "text": "Nobody knows."}]


def test_texts_hold_any_character(spark):
    rows = [(c, t, "user", f"a\0b {t}\n\nc") for c in range(8) for t in range(2)]
    found = chat.transcripts(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == 8 and all(r.text.count("\0") == 2 and r.text.count("\n\nc") == 2 for r in found)


@needs_data
def test_turns_come_back(spark):
    """Of conversations whose roles are recovered, the texts are those of the
    table unless a line of a turn reads like a marker."""
    tables = table(spark, SF, "conversations")
    said = {}
    for r in tables.distinct().orderBy("conv_id", "turn").collect():
        said.setdefault(r.conv_id, []).append((r.role, (r.text or "").strip()))
    rows = chat.transcripts(tables)
    model = chat.learn(rows)
    found = chat.format_chats(rows, model, keep=["conv_id"]).collect()
    right = 0
    for r in found:
        turns = [(t.role, t.text) for t in r.turns]
        marked = any(chat.marker(line)[0] for _, text in said[r.conv_id] for line in text.split("\n"))
        if not marked and [t[0] for t in turns] == [t[0] for t in said[r.conv_id]]:
            right += 1
            assert turns == said[r.conv_id]
    assert right > 0.9 * len(found)


def test_chat_odd_conversations(spark):
    rows = [(None, 0, "user", "a"), (1, None, None, None), (2, 0, "user", None), (2, 1, "poet", "x"),
            (3, 5_000, "user", "late"), (3, 1, "user", "early")]
    made = chat.transcripts(spark.createDataFrame(rows, SCHEMA))
    found = {(r.conv_id, r.chunk): r for r in made.collect()}
    assert set(found) == {(None, 0), (1, 0), (2, 0), (3, 0)} and all(r.last for r in found.values())
    assert found[1, 0].text == "" and found[3, 0].text.index("early") < found[3, 0].text.index("late")
    got = {r.conv_id: r for r in chat.format_conversations(made, model()).collect()}
    assert got[1].n_turns == 0 and got[1].rendered == "" and got[None].n_turns == 1
    empty = chat.transcripts(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and chat.format_chats(empty, chat.learn(empty)).count() == 0
    assert chat.format_conversations(empty, chat.learn(empty)).count() == 0


def long_talk(conv, turns, turn=lambda t: t):
    rng = np.random.default_rng(conv)
    said = ("Is this ok?", "Yes.\nSure.", "Why\n\nthen?", "Model: x", "word " * 20, "", None)
    return [(conv, turn(t), "user" if t % 2 == 0 else "assistant", said[rng.integers(len(said))]) for t in range(turns)]


def test_long_conversations_are_one_transcript(spark):
    """Pieces joined equal one pass over the whole text, in every style and
    at several levels of matrices."""
    short = [row for c in range(100, 140) for row in long_talk(c, 6)]
    rows = [row for c in range(12) for row in long_talk(c, 700)] + short
    made = chat.transcripts(spark.createDataFrame(rows, SCHEMA).repartition(5), chunk=16).cache()
    m = chat.learn(made)
    pieces = {}
    for r in made.collect():
        pieces.setdefault(r.conv_id, {})[r.chunk] = r
    found = {}
    for r in chat.format_conversations(made, m, fan=3).collect():
        found.setdefault(r.conv_id, {})[r.chunk] = r
    assert set(found) == set(range(12)) | set(range(100, 140))
    for conv, parts in pieces.items():
        order = sorted(parts)
        assert order == list(range(len(order))) and [parts[k].last for k in order] == [k == order[-1] for k in order]
        assert conv > 50 or len(order) > 3 ** 3     # turns without a line are left out
        assert all(len(parts[k].roles) <= 16 for k in order)
        turns = m.turns("\n".join(parts[k].text for k in order))
        assert "".join(found[conv][k].rendered for k in order) == chat.render(turns)
        assert sum(found[conv][k].n_turns for k in order) == len(turns)


def test_null_and_equal_turns_are_split(spark):
    rows = [(c, n, "user", f"Is this line {t} ok?") for c, n in ((1, None), (2, 7)) for t in range(1_000)]
    rows += rows[:300] + [(3, 0, "user", "again")] * 2_000
    made = chat.transcripts(spark.createDataFrame(rows, SCHEMA), chunk=32).collect()
    for conv in (1, 2):
        parts = sorted((r for r in made if r.conv_id == conv), key=lambda r: r.chunk)
        assert [r.chunk for r in parts] == list(range(len(parts))) and len(parts) >= 32
        assert max(len(r.roles) for r in parts) <= 32 and sum(len(r.roles) for r in parts) == 1_000
    assert [len(r.roles) for r in made if r.conv_id == 3] == [1]
