"""Page texts, personal data, secrets and quality rules against plain versions."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import credentials, html, pii, quality

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def personal_by_hand(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group(0))
            valid = {
                "email": lambda: True,
                "ip": lambda s=m.group(0): all(int(p) <= 255 for p in s.split(".")),
                "card": lambda d=digits: 16 <= len(d) <= 19 and pii.luhn(d),
                "phone": lambda d=digits: 8 <= len(d) <= 15,
            }[kind]()
            if valid:
                out.append((kind, *m.span()))
    return out


def test_personal_data_matches_patterns():
    rng = random.Random(5)
    seen = collections.Counter()
    bits = ["0123456789", "a@.b", "+ -().", "1 ", ".2", "4111111111111111 ", "@", "é", "4111 1111-11111111 ", " +1 (999) 555-0100. 10.0.0.1"]
    for _ in range(20_000):
        text = "".join(rng.choice(rng.choice(bits)) if rng.random() < 0.9 else rng.choice(bits) for _ in range(rng.choice([5, 12, 30])))
        want = personal_by_hand(text)
        assert [s for s in pii.find(text) if s[0] in pii.BASE] == want, text
        seen.update(k for k, *_ in want)
    assert all(seen[k] > 50 for k in PATTERNS)


def test_personal_data_of_its_own_kinds():
    text = "IBAN: GB82 WEST 1234 5698 7654 32, iban DE89370400440532013001 and https://me:pw@host.org/x"
    assert [(k, text[a:b]) for k, a, b in pii.find(text) if k not in pii.BASE] == [
        ("url", "https://me:pw@host.org"),
        ("account", "GB82 WEST 1234 5698 7654 32"),
    ]
    assert pii.find("see https://host.org/a:b and IBAN numbers") == []


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(1, "a@b.cd é token=abcdefgh1"), (1, "a@b.cd é token=abcdefgh1"), (2, None), (3, ""), (None, "x " * 50_000 + "q@r.st")]
    return spark.createDataFrame([(*r, [1], "s") for r in rows], "doc_id long, text string, spans array<int>, kind string")


def test_spans_of_odd_rows(odd):
    got = {(r["doc_id"], tuple(tuple(s) for s in r["spans"])) for r in pii.personal_data(odd).collect()}
    assert got == {(1, (("email", 0, 6),)), (2, ()), (3, ()), (None, (("email", 100_000, 106_000 - 5_994),))}
    got = sorted((str(r["doc_id"]), tuple(tuple(s) for s in r["spans"])) for r in credentials.secrets(odd, None).collect())
    assert got == [("1", (("assign", 9, 24),)), ("1", (("assign", 9, 24),)), ("2", ()), ("3", ()), ("None", ())]
    hidden = credentials.without_secrets(odd, None)
    assert hidden.columns == odd.columns
    assert {r["text"] for r in hidden.collect() if r["doc_id"] == 1} == {"a@b.cd é [secret]"}
    assert pii.personal_data(odd.limit(0)).count() == credentials.secrets(odd.limit(0), None).count() == 0


def secrets_by_hand(text):
    out = []
    for m in re.finditer(r"(?ai)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        out += [("assign", *m.span())] if len(m.group(2)) >= 8 else []
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group(0)) >= 16]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m.group(0)) >= 32]
    return sorted(out, key=lambda s: (s[1], credentials.KINDS.index(s[0])))


def test_base_secrets_match_patterns():
    rng = random.Random(6)
    bits = ["Token", "pass", "PASSWORD", "secret", "api_key", "apikey", " = ", ":", '"', "'", "AKIA", "ABCDEFGHIJ12", "0123456789abcdef", "x", " ", "ſecret:", "é"]
    found = collections.Counter()
    for _ in range(20_000):
        text = "".join(rng.choice(bits) for _ in range(rng.choice([3, 6, 10])))
        want = secrets_by_hand(text)
        assert credentials.base_spans(text) == want
        found.update(k for k, *_ in want)
    assert all(found[k] > 50 for k in credentials.BASE)


def test_network_finds_hidden_secrets():
    """Held-out accuracy: random keys are found, long words and dates are not."""
    rng = random.Random(7)
    syllables = ["the", "er", "tion", "an", "re", "ou", "st", "ing", "ly", "ha"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 9)))
    key = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") for _ in range(rng.randrange(20, 60)))
    around = lambda s: f"{word()} {word()} {s} {word()} {word()}"
    good = [(t, t.index(k), t.index(k) + len(k)) for k in (key() for _ in range(1000)) for t in [around(k)]]
    bad = [(t, m.start(), m.end()) for t in (around(" ".join(word() for _ in range(20))) for _ in range(300)) for m in credentials.RUN.finditer(t)]
    half = [g for g in good[:700]], bad[: len(bad) // 2]
    codes = [v for part in half for e in part for v in credentials.views(*e)]
    y = np.array([1] * sum(len(credentials.views(*e)) for e in half[0]) + [0] * sum(len(credentials.views(*e)) for e in half[1]))
    network = credentials.fit(np.array(codes, np.int16), y)
    score = lambda e: network.probability(np.array(credentials.views(*e), np.int16)).max()
    assert np.mean([score(e) >= network.threshold for e in good[700:]]) > 0.9
    assert np.mean([score(e) >= network.threshold for e in bad[len(bad) // 2 :]]) < 0.01
    text = around("Zk3vQ9xT2mB7pL5wR8sD1f")
    (spans,) = credentials.find([text], network)
    assert [text[a:b] for k, a, b in spans] == ["Zk3vQ9xT2mB7pL5wR8sD1f"]


KEY_CHARS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"


def test_threshold_keeps_recall_beside_unknown_keys():
    """Keys among what is called harmless do not lift the threshold above their kind."""
    rng = random.Random(9)
    key = lambda: "".join(rng.choice(KEY_CHARS) for _ in range(40))
    word = lambda: "".join(rng.choice(["the", "er", "tion", "an", "ou"]) for _ in range(9))
    seen = lambda s: credentials.views(f"one {s} two", 4, 4 + len(s))[0]
    codes = [seen(key()) for _ in range(300)] + [seen(word()) for _ in range(300)] + [seen(key()) for _ in range(12)]
    network = credentials.fit(np.array(codes, np.int16), np.array([1] * 300 + [0] * 312))
    assert network.threshold <= 1
    assert np.mean([network.probability(np.array([seen(key())], np.int16))[0] >= network.threshold for _ in range(200)]) > 0.85
    assert [credentials.may_be_key(s) for s in ("ghp_16C7e42F292c6912E7710c838347Ae178B4a", "thanonontioniner", "4785380592391139")] == [True, False, False]


def test_candidates_by_cue_and_beside_base_spans():
    hexed = "0123456789abcdef" * 2
    cases = {
        f"x Zk3vQ9xT2mB7pL5w-{hexed} y": ["Zk3vQ9xT2mB7pL5w-"],
        f"x Zk3vQ9xT2mB7pL5w-{hexed}-tail y": ["Zk3vQ9xT2mB7pL5w-", "-tail"],
        "the password is hunter2!x9, and so on": ["hunter2!x9"],
        "pwd: ab.C1@d#4 next": ["ab.C1@d#4"],
        "Authorization: Bearer abc.DEF!ghi": ["Bearer", "abc.DEF!ghi"],
        "see QwErTyUiOpAsDfGhJkL here": ["QwErTyUiOpAsDfGhJkL"],
        "a hunter2!x9 without anything": [],
        "the key is late": [],
    }
    for text, want in cases.items():
        assert [text[a:b] for a, b, _ in credentials.candidates(text, credentials.base_spans(text))] == [w for w in want if w != "Bearer"], text


def test_cued_and_split_secrets_are_found(spark):
    rng = random.Random(10)
    draw = lambda n: "".join(rng.choice(KEY_CHARS) for _ in range(n))
    prose = "the words of this text are ordinary everyday language about something password protected "
    docs = [(i, f'{prose} token = "{draw(rng.randrange(9, 40))}" {prose} anotherverylongordinaryword') for i in range(400)]
    network = credentials.train(spark.createDataFrame(docs, "doc_id long, text string"))
    cued = [f"{prose} password is {draw(6)}!{draw(7)} {prose}" for _ in range(100)]
    split = [f"{prose} {draw(20)}-{'0123456789abcdef' * 2} {prose}" for _ in range(100)]
    letters = [f"{prose} {re.sub('[0-9]', 'x', draw(30))} {prose}" for _ in range(100)]
    shown = lambda texts: np.mean([any(s[0] == "model" for s in found) for found in credentials.find(texts, network)])
    assert min(shown(cued), shown(split), shown(letters)) > 0.9
    assert shown([prose * 3] * 5) == 0


def counts_by_hand(text):
    words = [w for w in re.split("[ \t-\r]+", text) if w]
    windows = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    repeated = [False] * len(words)
    for i in range(len(words) - 4):
        if windows[tuple(words[i : i + 5])] > 1:
            repeated[i : i + 5] = [True] * 5
    seen, copies = set(), 0
    for line in text.split("\n"):
        if re.search("[^ \t-\r]", line):
            copies += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), copies, sum(repeated)


def test_quality_counts():
    rng = random.Random(8)
    bits = ["a ", "b ", "\n", "é", "#|", " ", "\t", "\r\n", "a b c d e f\n", "日本 ", "x y\n"]
    texts = ["", "  \n", "a", "a\na\n a\na", *("".join(rng.choice(bits) for _ in range(rng.randrange(60))) for _ in range(400))]
    got = quality.count(pa.array(texts))
    for i, text in enumerate(texts):
        assert tuple(int(c[i]) for c in got[:5]) == counts_by_hand(text), text


def test_field_by_enumeration():
    """Viterbi and likelihood against all label sequences, the gradient against differences."""
    import itertools

    rng = np.random.default_rng(1)
    bounds, move = np.array([0, 4, 4, 5]), rng.normal(size=(2, 2))
    score, labels = rng.normal(size=(5, 2)), np.array([1, 0, 0, 1, 1])

    def path(z, a):
        return sum(score[a + i, y] for i, y in enumerate(z)) + sum(move[y, v] for y, v in itertools.pairwise(z))

    best, value = quality.viterbi(score, move, bounds), 0.0
    for a, b in ((0, 4), (4, 5)):
        ways = list(itertools.product((0, 1), repeat=b - a))
        assert tuple(best[a:b]) == max(ways, key=lambda z: path(z, a))
        value += path(labels[a:b], a) - np.log(sum(np.exp(path(z, a)) for z in ways))
    got, marginal, _ = quality.log_likelihood(score, move, bounds, labels)
    assert got == pytest.approx(value)
    assert marginal.sum(axis=1) == pytest.approx(np.ones(5))


def test_quality_of_labelled_documents(spark, tiny):
    """Held out: junk goes, clean documents stay."""
    docs, labels = spark.read.parquet(f"{tiny}/../sf0.01/documents.parquet"), spark.read.parquet(f"{tiny}/../sf0.01/labels.parquet")
    field = quality.train(docs.filter("doc_id % 3 > 0"), labels)
    rest = docs.filter("doc_id % 3 = 0").join(labels, "doc_id")
    rows = quality.judged(rest, field).join(labels, "doc_id").filter("NOT base_failed").collect()
    assert np.mean([r["kept"] for r in rows if r["quality"] == 1]) > 0.98
    assert np.mean([r["kept"] for r in rows if r["quality"] == 0]) < 0.2
    kept = quality.without_rejected(docs, field)
    assert kept.columns == docs.columns
    odd = spark.createDataFrame([(None, "w " * 9), (1, None), (2, ""), (2, "a b c d e f g h i j k")], "doc_id long, text string")
    assert sorted((r["n_words"], r["kept"]) for r in quality.judged(odd, None).collect()) == [(0, False), (0, False), (9, False), (11, True)]
    assert quality.train(docs, labels.limit(0)) is None


def test_threshold_beside_wrong_labels():
    good, bad = np.linspace(0.8, 1, 500), np.linspace(0, 0.1, 500)
    wrong = np.concatenate([good, [0.0, 0.01, 0.02]])
    for shares in (good, wrong):
        assert 0.09 < quality.threshold(shares, np.concatenate([bad, [0.9]]), quality.LOST) <= 0.5
    assert quality.threshold(good, good, quality.LOST) == 0


def test_threshold_above_a_half():
    """Where bad documents are mostly content too, the threshold still parts them from good ones; a share of one is no bound either."""
    good, bad = np.linspace(0.8, 1, 500), np.linspace(0.55, 0.7, 500)
    assert 0.69 < quality.threshold(good, bad, quality.LOST) <= 0.8
    assert 0.99 < quality.threshold(np.ones(500), np.full(500, 0.99), quality.LOST) <= 1
    assert quality.threshold(bad, good, quality.LOST) == 0


def test_sample_is_of_usable_documents(spark):
    """Labels of documents that are absent or too long take no place in the sample."""
    text = lambda i: ("some words of a clean text. " if i % 2 else "# | # | %% MENU | ") * 4 + str(i)
    docs = spark.createDataFrame([(i, text(i)) for i in range(40)] + [(i, "x" * 999) for i in range(40, 400)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(4000)], "doc_id long, quality int")
    assert quality.train(docs, labels, rows=4, chars=500) is not None
    with pytest.warns(UserWarning, match="rules alone"):
        assert quality.train(docs, labels.filter("quality = 1"), rows=4, chars=500) is None


PAGES = [
    (None, ""),
    ("", ""),
    ("plain &lt;b&gt; text", "plain <b> text"),
    ("<p>a<p>b <b>c</b>d<br>e<script>x<p></script><!-- <p>no</p> -->", "a b cd e"),
    ("<article><header><h1>T</h1></header><p>one<section><p>two</p></section><aside>no</aside></article><footer>f</footer>", "T one two"),
    ("<nav><ul><li><a href=/x>menu</a></ul></nav><main><p>x &amp; y\n  z</p></main><div class='cookie-notice'>ok?</div>", "x & y z"),
    ("<body><div id=header>H</div><div><p>The text of the page, long enough.</p><p>More &eacute;.</p></div><div id=comments><p>me too</p></div>", "The text of the page, long enough. More é."),
    ("<div><form><input><button>go</button></form><p>in<b>line</b> <i>text</i></p></div>", "inline text"),
]


def test_main_texts(spark):
    pages = spark.createDataFrame([(i, "u", p, "x") for i, (p, _) in enumerate(PAGES)] + [(0, None, "<p>r</p>", "x")] * 2, "page_id long, url string, html string, text string")
    got = collections.Counter((r["page_id"], r["text"], r["n_chars"]) for r in html.main_texts(pages).collect())
    want = collections.Counter([(i, t, len(t)) for i, (_, t) in enumerate(PAGES)] + [(0, "r", 1)] * 2)
    assert got == want
    assert html.main_texts(pages.limit(0)).count() == 0


def test_main_text_of_the_given_pages(spark, tiny):
    """The article elements of the given pages, cut out by patterns."""
    import html as entities

    rows = spark.read.parquet(f"{tiny}/pages.parquet").collect()
    for r in rows:
        inner = re.search("<article>(.*?)</article>", r["html"], re.S).group(1)
        blocks = (" ".join(entities.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1|br)>", inner))
        assert html.main_text(r["html"]) == " ".join(b for b in blocks if b)


LONG = "The text of the page is long enough to be the page. " * 3
KEPT = [
    (f'<div class="layout with-sidebar"><main><article><p>{LONG}</p></article></main></div>', LONG),
    (f'<div class="sidebar"><main><p>{LONG}</p></main></div><div class="sidebar">s</div>', LONG),
    (f'<form id="page"><nav><a href="/">n</a></nav><div><p>{LONG}</p></div></form>', LONG),
    (f'<div class="promo"><p>{LONG}</p></div><div><p>x</p></div>', f"{LONG}x"),
    ('<article><h2 id="related">A</h2><p>a</p><section id="social-impact"><p>b</p></section><p class="notice">c</p><div class="notice">d</div></article>', "A a b c"),
    ('<main><p><a href="/wiki/Hidden_Figures">A</a> <i title="hidden costs">b</i> <b data-hidden="false">c</b> <a href="?id=3&class=promo">d</a> <i hidden>no</i></p></main>', "A b c d"),
    ("<p>If <math><mi>x</mi><mo>=</mo><mn>1</mn></math> then</p>", "If x=1 then"),
    (f'<article><p>{LONG}</p><div class="related"><a href="x">one</a></div><div class="wide ad">buy</div></article>', LONG),
    (f'<article><p>short</p></article><div id="comments"><article><p>{LONG}</p></article></div>', "short"),
]

KEPT += [
    (f'<article><p>{LONG}</p><div class="{name}"><p>Not of the article at all.</p></div></article>', LONG)
    for name in ("post-comments", "ad-slot", "share-buttons", "newsletter-signup", "related-posts", "comment_list wide")
]
KEPT += [
    (f'<div><div class="text"><p>{LONG}</p></div><div class="sidebar-left"><p>Other things.</p></div></div>', LONG),
    (f'<main><div class="notice">We use cookies.</div><p>{LONG}</p><div class="consent"><p>Do you agree?</p></div></main>', LONG),
    (f'<main><div class="notice"><p>{LONG}</p></div><p>x</p></main>', f"{LONG}x"),
    (f'<article><p>{LONG}</p><section id="related-work"><p>r</p></section><section id="share-of-market"><p>s</p></section></article>', f"{LONG}r s"),
]


@pytest.mark.parametrize("page, want", KEPT)
def test_names_do_not_cut_the_article(page, want):
    assert html.main_text(page) == want.strip()


def test_hard_pages_end():
    for page in ("<div>" * 5000 + "x", "<p " * 5000, "<!--" * 5000, "<b>" * 5000 + "x" + "</i>" * 5000, "<a href='" + "x" * 50_000):
        html.main_text(page)
