"""Encoding, packing and page extraction against the libraries and plain versions."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from odd_texts import ODD

from roadpulse.llm import html, packing, pieces

PIECES, BPE = P.path("piece_bpe_32k.model"), P.path("byte_bpe_50k.json")


def test_pieces_equal_the_library(spark, documents, prose):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = [*ODD, prose(3000, 1), prose(50, 2), prose(50, 2)]
    rows = list(enumerate(texts)) + [(None, "no id"), (3, "id again")]
    got = pieces.digests(documents(rows, extra=True), PIECES).collect()
    expected = []
    for i, t in rows:
        ids = [1, *model.encode(t or ""), 2]
        raw = np.array(ids, "<u4").tobytes()
        expected.append((i, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(model.decode(ids).encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)
    whole = {r["doc_id"]: r for r in pieces.encode(documents(rows[: len(texts)]), PIECES).collect()}
    for i, t in rows[: len(texts)]:
        ids = model.encode(t or "")
        assert whole[i]["ids"] == [1, *ids, 2] and whole[i]["decoded"] == model.decode(ids)
    assert pieces.digests(documents([]), PIECES).count() == 0


def test_piece_table_may_overflow(monkeypatch, prose):
    monkeypatch.setattr(pieces, "TABLE_ENTRIES", 40)
    code = pieces.Coder(PIECES)
    for seed in range(8):
        texts = [prose(30, seed), prose(5, 0), "a  b "]
        for t, (ids, decoded) in zip(texts, code(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == [1, *code.model.encode(t), 2] and decoded == t


def _ids(text):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(BPE)
    return [*model.encode(text or "", add_special_tokens=False).ids, 0]


def test_packing(spark, documents, prose):
    texts = [*ODD, "a <|endoftext|> b", "x<|endoftext|>", *[prose(30 + 7 * k, k) for k in range(60)], prose(5000, 99), prose(30, 0)]
    rows = list(enumerate(texts)) + [(None, "no id"), (3, "id again")]
    got = packing.pack(packing.pieces(documents(rows, extra=True), BPE)).collect()
    by = {}
    for i, t in rows:
        by.setdefault(i, []).append(_ids(t))
    for i, sets in by.items():
        own = [r for r in got if r["doc_id"] == i]
        expected = []
        for ids in sets:
            first = len(ids) % 2048 or 2048
            cuts = [0, *range(first, len(ids) + 1, 2048)]
            for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                expected.append((k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
        assert sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in own) == sorted(expected)
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= -(-sum(r["length"] for r in got) // 2048) + 1
    assert packing.pack(packing.pieces(documents([]), BPE)).count() == 0


@pytest.mark.parametrize("seed", [0, 7, 8, 20])
def test_evolution_improves_on_best_fit(seed):
    r = random.Random(seed)
    n = r.choice([40, 80, 120])
    length = [r.randint(10, 70) for _ in range(n)]
    least = -(-sum(length) // 100)
    assert len(set(packing.evolve(length, [], 100, 1, generations=0))) == least + 1
    bins = packing.evolve(length, [], 100, 1, generations=60)
    assert np.bincount(bins, weights=length).max() <= 100 and len(set(bins)) == least
    assert packing.evolve(length, [], 100, 1, generations=60) == bins
    # an elite that migrates is not lost
    assert len(set(packing.evolve(length, [list(range(n)), bins], 100, 2, generations=1))) == least


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no";</script></head><body>
<header><a href="/">Home</a></header><nav><ul><li><a href="/a">A</a></li><li><a>B</a></li></ul></nav>
<div class="cookie-notice">We use cookies on this page and many others too.</div><!-- a remark -->
%s
<div id="comments"><p>A reader said that this long remark is no part of the article at all.</p></div>
<form><p>Name</p><input></form><footer>&copy; somebody</footer></body></html>"""


@pytest.mark.parametrize("wrap", ["<article>%s</article>", "<main><div class='body'>%s</div></main>", "<div class='text'>%s</div>"])
def test_page_text(wrap):
    body = (
        "<h1>The heading is a line of text &amp; more</h1><p>First <b>bold</b>\n  paragraph with enough words to count as text.</p>"
        "<p>Second paragraph, &lt;quoted&gt;, that also has plenty of words in it.<p>Third one without its end tag, just as long as others."
    )
    expected = (
        "The heading is a line of text & more First bold paragraph with enough words to count as text. "
        "Second paragraph, <quoted>, that also has plenty of words in it. Third one without its end tag, just as long as others."
    )
    assert html.main_text(PAGE % (wrap % body)) == expected


TEASER = "<article class='%s'><h3><a href='/x'>Next</a></h3><p><a href='/x'>More</a></p></article>"


@pytest.mark.parametrize("kind", ["teaser", "related", "box"])
def test_body_beside_small_articles(kind):
    body = [f"Paragraph {k} of the body has a good many words, as the text of a page has." for k in range(12)]
    page = "<div class='text'>%s</div><ul>%s</ul>%s" % ("".join(f"<p>{p}</p>" for p in body), "<li><a>x</a></li>" * 8, TEASER % kind * 3)
    got = html.main_text(PAGE % page)
    assert got.startswith(" ".join(body)) and "More" not in got  # the smoothing may lift a line next to the body
    # a body in two places: the part outside the article stays, the short line inside it too
    page = "<div>%s</div><article>%s<p>Short.</p></article>" % tuple("".join(f"<p>{p}</p>" for p in part) for part in (body[:6], body[6:]))
    assert html.main_text(PAGE % page) == " ".join(body) + " Short."


BESIDE = (
    "<div class='sidebar'><p>Most read on this site today: a long list of other pieces.</p></div>",
    "<aside><article><p>A small box beside the text with one sentence of its own.</p></article></aside>",
    "<ol class='comment-list'>" + "<li><article class='comment'><p>A reader writes a rather long remark about this piece.</p></article></li>" * 9 + "</ol>",
    "<form action='/subscribe'><p>Leave your address to get a letter with news each week.</p><input><button>Go</button></form>",
)
WRAPPERS = (
    "<form id=aspnetForm>%s</form>", "<div class='page no-sidebar'>%s</div>", "<div class='layout has-sidebar'>%s</div>", "<div class='post comments-open'>%s</div>",
    "<div class='sidebar-layout menu-page'>%s</div>", "<div aria-hidden='true'>%s</div>", "<form><div class='widget'>%s</div></form>",
)


@pytest.mark.parametrize("element", ["article", "main", "div"])
@pytest.mark.parametrize("wrapper", WRAPPERS)
@pytest.mark.parametrize("beside", [(), *((b,) for b in BESIDE), BESIDE])
def test_wrappers_of_the_page(wrapper, element, beside):
    body = [f"Paragraph {k} of the article says a good many things, in words enough for the ratio of text to tags to be high." for k in range(3)]
    page = f"<{element}>{''.join(f'<p>{p}</p>' for p in body)}</{element}>" + "".join(beside)
    assert html.main_text(PAGE % (wrapper % page)) == " ".join(body)


def _plain_ratios(lines, sigma=1.5, share=0.5):
    """The rule written out: ratios, Gaussian weights by distance up to the reach, threshold at a share of the mean."""
    ratio = [0 if beside else len(text) / tags for text, tags, beside, _ in lines]
    reach = round(3 * sigma)
    weight = {d: np.exp(-d * d / (2 * sigma * sigma)) for d in range(-reach, reach + 1)}
    smooth = [sum(w * ratio[i + d] for d, w in weight.items() if 0 <= i + d < len(ratio)) / sum(weight.values()) for i in range(len(ratio))]
    high = [s > share * np.mean(smooth) and not line[2] for s, line in zip(smooth, lines, strict=True)]
    if not any(high):
        return [line[3] != 0 and not line[2] for line in lines]
    grown = {line[3] for h, line in zip(high, lines, strict=True) if h and line[3] > 0}
    return [h or line[3] in grown and not line[2] for h, line in zip(high, lines, strict=True)]


@pytest.mark.parametrize("seed", range(8))
def test_ratio_rule(seed):
    r = random.Random(seed)
    lines = [("x" * r.choice([3, 40, 300]), r.randint(1, 12), r.random() < 0.2, r.choice([0, 0, 1, -2])) for _ in range(r.randint(1, 60))]
    assert html.content(lines).tolist() == _plain_ratios(lines)


def test_threshold_decides_beside_an_article():
    lines = [("a" * 200, 2, False, 0), *[("b", 9, False, 0)] * 8, *[("c" * 200, 2, False, 1), ("d", 9, False, 1)] * 2]
    assert html.content(lines).tolist()[0] and not html.content(lines)[4:6].any()
    assert not html.content(lines, share=1e9)[:9].any() and html.content(lines, share=1e9)[9:].all()


@pytest.mark.parametrize(
    "odd", ["<![foo[x]]>", "<![ CDATA[x]]>", "<![x>", "<![>", "<![CDATA[x]]>", "<![if !IE]>", "<![endif]-->", "<svg><![CDATA[<p>]]></svg>"]
)
def test_text_behind_sections(odd):
    assert html.main_text(f"<p>one</p>{odd}<p>two</p>") == "one two"
    assert html.main_text(f"<article><p>one</p><p>{odd}two</p>") == "one two"


def test_text_behind_long_references():
    assert html.main_text(f"<p title='&#{'9' * 5000};'>one &#{'9' * 5000}; &#{'0' * 5000}65;</p><p>two</p>") == "one \ufffd A two"


def test_pages(spark):
    rows = [(1, "u", PAGE % "<article><p>Short.</p></article>"), (2, None, None), (3, "u", ""), (3, "u", "<p>bare text<p"), (None, "u", "no tags"),
            (5, "u", "<article><p>cut off in the <b>mid"), (6, "u", "</div></p><![bad<!--"), (7, "u", "<p>" + "w " * 40000)]
    got = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    text = {(r["page_id"], r["text"]) for r in got}
    assert {(1, "Short."), (2, ""), (3, ""), (None, "no tags"), (5, "cut off in the mid")} <= text
    assert max(r["n_chars"] for r in got) == 2 * 40000 - 1
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_letter_words_go_straight_to_the_merges(prose):
    """Distinct words of letters cost no run of the whole tokenizer, and their ids are those of the library."""
    dice = random.Random(7)
    letters = "abcdefghijklmnopqrstuvwxyzÀÖØöøÿĀſƀǃɏ"
    words = ["".join(dice.choices(letters, k=dice.randint(1, 14))) for _ in range(3000)]
    odd = [f"{a}{m}{b}" for a, m, b in zip(words[:40], "×÷ʼɐ߀'’_0-.,;\xa0ªµ́\n" * 3, words[40:])]
    marked = [w + dice.choice(["", "", ".", ",", ".\nThe", "\n", "###"]) for w in words]
    code = packing.Coder(BPE)
    plain, given = code._plain, []
    code._plain = lambda text: (given.append(text), plain(text))[1]
    for text in (" ".join(words), " ".join(marked), " ".join(odd), "\n".join(words)):
        given.clear()
        got = np.frombuffer(code([f"x {text}"])[0], "<u4").tolist()
        assert [*got, 0] == _ids(f"x {text}")
        if text == " ".join(words):
            assert sum(map(len, given)) < 10
