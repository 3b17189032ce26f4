import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from rollmark.llm import decontamination, packing, page_text, queries, secret_scan
from tests.llm.rows import ODD, documents, frame, prose


def test_packing_round_trip(spark):
    rng = random.Random(2)
    rows = documents(each=6) + ODD + [(700, prose(rng, "en", 30_000), "en", "s", 0), (701, "数字 <|endoftext|> ok", "", "", 0)]
    got = packing.pack(frame(spark, rows).selectExpr("*", "1 as ids", "2 as length"), segments=4).collect()
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {}
    for p in sorted(got, key=lambda p: (p.doc_id is None, p.doc_id or 0, p.start)):
        ids.setdefault(p.doc_id, []).extend(np.frombuffer(p.ids, "<u4").tolist())
        assert len(p.ids) == 4 * p.length
    for doc, text, *_ in rows:
        want = whole.encode(text or "", add_special_tokens=False).ids + [1]
        assert ids[doc] == want * (2 if doc == 905 else 1) or doc == 905 and sorted(ids[doc]) == sorted(want * 2)
    sequences = {}
    for p in got:
        sequences.setdefault(p.sequence_id, []).append(p)
    for pieces in sequences.values():
        pieces.sort(key=lambda p: p.offset)
        assert [p.offset for p in pieces] == np.cumsum([0] + [p.length for p in pieces])[:-1].tolist()
        total = sum(p.length for p in pieces)
        assert len(pieces) <= 4 and total <= 2048 and total & (total - 1) == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 300), st.integers(0, 300)), max_size=60), st.integers(1, 6), st.integers(1, 64))
def test_packing_keeps_all_limits(docs, segments, loss):
    packer = packing.Packer(64, segments, loss, waiting=8)
    out = []
    for k, (n, loss_from) in enumerate(docs):
        out += packer.add(packing.Piece(k, np.arange(n), 0, n, loss_from))
    out += packer.finish()
    seen = {}
    for sequence in out:
        total = sum(p.length for p in sequence)
        assert 0 < total <= 64 and total & (total - 1) == 0
        assert len(sequence) <= segments and sum(p.loss() for p in sequence) <= loss
        for p in sequence:
            seen.setdefault(p.doc, []).append((p.start, p.length))
    for k, (n, _) in enumerate(docs):
        at = 0
        for start, length in sorted(seen[k]):
            assert start == at and length > 0
            at += length
        assert at == n


def base(text):
    text, out = text or "", []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[2]) >= 8:
            out.append(("assign", m.start(), m.end()))
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out, key=lambda s: (s[1], ["assign", "access", "hex"].index(s[0])))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["password", "Token", "api_key", "secret", "=", ":", " ", '"', "abcdefgh", "AKIA", "ABCDEFGHIJKLM",
                                 "0123456789abcdef" * 2, "ſecret", "é", "short", "token=", "pwd -> X9$kQz!72bLm"]), max_size=12))
def test_base_spans(parts):
    text = "".join(parts)
    assert [s for s in secret_scan.spans(text) if s[0] != "guess"] == base(text)


def test_guess_costs():
    cheap = ["password1", "qwertyuiop", "aaaaaaaaaaaa", "abcdefghijkl", "20240131", "changeme2024", "P@ssw0rd", "drowssap"]
    dear = ["X9$kQz!72bLm", "v8Jq2nR0xTz4", "04dbebab91ab85687d33eeaaf9ac699e1188f962"]
    assert max(map(secret_scan.guesses, cheap)) < secret_scan.GUESSES < min(map(secret_scan.guesses, dear))
    assert secret_scan.guesses("ab" * 20_000) > 0
    found = secret_scan.spans("the pwd is X9$kQz!72bLm today; the pwd is changeme2024 now")
    assert found == [("guess", 11, 23)]


def test_secrets_query_and_redaction(spark, tmp_path):
    rows = ODD + [(1, 'é token = "%s" end' % ("0f" * 20), "", "", 0), (2, "x" * 200_000 + " AKIA" + "Q" * 16, "", "", 0)]
    frame(spark, rows).selectExpr("*", "1 as secrets", "'a' as spans").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op10_secrets(spark, str(tmp_path)).collect()}
    assert (got[1].n_assign, got[1].n_access, got[1].n_hex) == (1, 0, 1)
    assert got[1].spans.startswith("assign:2:51,hex:11:51") and got[2].spans == "access:200001:200021"
    import hashlib

    assert got[1].base_sha256 == hashlib.sha256(b"assign:2:51,hex:11:51").hexdigest()
    assert got[900].base_sha256 == hashlib.sha256(b"").hexdigest() and got[900].spans == ""
    clean = {r.doc_id: r.text for r in secret_scan.redact(frame(spark, rows)).collect()}
    assert clean[1] == 'é [secret]" end' and clean[900] is None and clean[904] == "x"
    assert secret_scan.find_secrets(frame(spark, [])).collect() == []


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>
<nav><ul><li><a href="/a">Home {n}</a></li></ul></nav><div class="ad">Buy {n}</div><div>Site slogan</div>
<article><h1>Title &amp; {n}</h1><p>First   <b>bold {n}</b><br>line.<p>Same for all.</p><section id="comments"><p>Nice {n}</p></section>
<form><label>Mail</label></form></article><script>var t="</p>";x({n});</script><footer>&copy; me {n}</footer></body></html>"""


def test_names_of_wrappers_and_other_attributes_cost_no_article():
    words = "The article itself, which is long enough to be told from anything beside it."
    for page in (
        f'<body><div class="layout has-sidebar"><article><p>{words}</p></article></div></body>',
        f'<body><div data-id="menu" data-class=sidebar><p>{words}</p></div></body>',
        f'<body><div class="sidebar"><article><p>{words}</p></article></div><div class="sidebar">Also here</div></body>',
        f'<body><div class="widget"><p>{words}</p></div><p>So.</p></body>'.replace("<p>So.</p>", ""),
    ):
        assert page_text.page_text(page, {}) == words
    page = f'<article><p>{words}</p><div class="post-comments"><article class="comment">Nice</article></div></article>'
    assert page_text.page_text(page, {}) == words


def test_the_template_tells_menus_without_any_name(spark):
    """One host, no article element, no name of furniture: what its pages share goes, and without the
    template it stays."""
    rng = random.Random(4)
    page = ('<html><body><div class="x1"><div>All our topics</div><div>Contact and imprint</div></div><div class="x2"><h2>{h}</h2>'
            '<p>{p}</p><p>{q}</p></div><div class="x3"><span>Made with care by us</span></div></body></html>')
    said = [[prose(rng, "en", n) for n in (4, 30, 20)] for _ in range(8)]
    rows = [(k, f"http://x.example/{k}", page.format(h=h, p=p, q=q)) for k, (h, p, q) in enumerate(said)]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in page_text.extract_pages(table).collect()}
    assert got == {k: "\n\n".join(parts) for k, parts in enumerate(said)}
    for k, (_, _, one) in enumerate(rows):
        alone = page_text.page_text(one, {})
        assert alone != got[k] and "Contact and imprint" in alone and "Made with care" in alone


def test_pages_of_a_large_host_meet_its_template_in_parts(spark, monkeypatch):
    rows = [(k, f"http://A.example/{k}", PAGE.format(n=k)) for k in range(30)] + [(99, None, None), (99, None, None)]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 as part", "2 as page")
    whole = sorted(page_text.extract_pages(table).collect())
    monkeypatch.setattr(page_text, "PART", 4)
    assert sorted(page_text.extract_pages(table).collect()) == whole and len(whole) == 32


def test_pages(spark):
    rows = [(k, f"http://A.example/{k}", PAGE.format(n=k)) for k in range(6)]
    rows += [(10, None, "<p>loose</p> text"), (11, "http://b.example/", None), (12, "x", ""), (None, "http://b.example/2", "<article>a<p>b &lt;c&gt;"),
             (13, "http://c.example", "<div>" * 3000 + "deep" + "</div>" * 3000), (14, "http://c.example", "<main><p>a < b <p title='>'>c</main><p>out")]
    pages = spark.createDataFrame(rows + rows[:1], "page_id bigint, url string, html string").selectExpr("*", "1 as text", "2 as host", "3 as template")
    got = page_text.extract_pages(pages).collect()
    assert len(got) == len(rows) + 1
    text = {r.page_id: r.text for r in got}
    for k in range(6):
        assert text[k] == f"Title & {k}\n\nFirst bold {k} line.\n\nSame for all."
    assert text[10] == "loose\n\ntext" and text[11] == text[12] == "" and text[None] == "a\n\nb <c>"
    assert text[13] == "deep" and text[14] == "a < b\n\nc"
    assert all(r.n_chars == len(r.text) for r in got)
    assert page_text.extract_pages(pages.limit(0)).collect() == []


def test_template_text_outside_articles_goes():
    shared = "<html><body><div>Same on all</div><div>Story number {n} is here.</div><div>More of the same</div></body></html>"
    tokens = [page_text._mark(t) for t, _ in page_text.tokens(shared.format(n=1))]
    fixed = {m: tokens.count(m) for m in tokens if m != page_text._mark("/html/body/div#Story number 1 is here.")}
    assert page_text.page_text(shared.format(n=1), fixed) == "Story number 1 is here."
    assert page_text._template_places([1, 2, 9, 1, 2], {1: 5, 2: 5}) == {0, 1, 3, 4}
    assert page_text._template_places([1, 2, 2, 1], {1: 5, 2: 5}) == set()


def brute_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
        row = new
    return row[-1]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=80), st.lists(st.integers(0, 5), max_size=80))
def test_common_subsequence(a, b):
    assert decontamination.common_subsequence(a, b) == brute_lcs(a, b)


def test_leaks(spark):
    rng = random.Random(9)
    items = [(k, prose(rng, ("en", "de", "fr", "es")[k % 4], rng.randint(12, 50))) for k in range(20)] + [(90, None), (91, "--")]
    rows = documents(each=20) + ODD
    want = set()
    for k, text in items[:20]:
        words = text.split()
        if k % 2:
            words[3], words[8] = "other", "words"  # a paraphrase
        doc = prose(rng, "en", 40) + " " + " ".join(words).replace("th", "TH") + ", " + prose(rng, "en", 37)
        rows.append((500 + k, doc if k != 4 else text, "en", "s", 0))
        want.add((500 + k, k))
    docs = frame(spark, rows).selectExpr("*", "1 as item_id", "2 as bucket")
    benchmark = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "3 as doc_id")
    got = decontamination.leaks(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want
    assert decontamination.leaks(docs.limit(0), benchmark).collect() == []
    assert decontamination.leaks(docs, benchmark.limit(0)).collect() == []


@pytest.mark.parametrize("edit", ["copied", "replaced", "left out", "inserted"])
def test_leaks_are_found_down_to_the_covered_share(spark, edit):
    rng = random.Random(31)
    items = [(k, prose(rng, "en", rng.randint(17, 60))) for k in range(40)]
    rows = documents(each=20)
    want = set()
    for k, text in items:
        words = text.split()
        n = len(words)
        # two of the four answer words stay
        counts = [words.count(w) for w in words]
        kept = set(sorted(range(n), key=lambda p: (counts[p], -len(words[p]), p))[:12])
        some = rng.sample([p for p in range(n) if p not in kept], min(n - 12, int(0.38 * n)))
        if edit == "replaced":
            words = [f"zz{p}" if p in some else w for p, w in enumerate(words)]
        elif edit == "left out":
            words = [w for p, w in enumerate(words) if p not in some]
        elif edit == "inserted":
            words = [x for p, w in enumerate(words) for x in ([w, f"zz{p}"] if p % 2 else [w])]
        rows.append((500 + k, prose(rng, "en", 45) + " " + " ".join(words) + " " + prose(rng, "en", 45), "en", "s", 0))
        answer = max(rng.sample(sorted(kept), 2))
        want.add((500 + k, k))
        items[k] = (k, text, text.split()[answer])
    benchmark = spark.createDataFrame(items, "item_id bigint, text string, answer string")
    got = decontamination.leaks(frame(spark, rows), benchmark, answer="answer").collect()
    assert want <= {(r.doc_id, r.item_id) for r in got}


def test_repeated_words_and_the_end_of_an_item_count():
    # six of ten words in order, all the same word
    idf, space = np.ones(1 << decontamination.BITS, np.float32), np.ones((1 << decontamination.BITS, 2), np.float32)
    items = decontamination.Items([1], ["a a a a a a b c d e"], ["a"], idf, space)
    batch = pa.RecordBatch.from_pydict({"id": pa.array([7], pa.int64()), "text": pa.array(["x y a a a a a a z"])})
    (out,) = decontamination._searched(items, space, 0.3, 0.6, 0.5)([batch])
    assert out.column(0).to_pylist() == [7] and out.column(2).to_pylist() == [0.6]
    assert len(decontamination.Items([1], [" ".join("abcdefghijklmnopqrst")], [None], idf, space).vectors) == 2


def test_template_decides_inside_and_outside_articles(spark):
    story = "Paragraph {n} tells a story of its own, and a long one it is, with {n} turns on the way to its end."
    shared = ("<html><body><article><h1>Title {n}</h1><div class='note'>Read our terms of use.</div><p>" + story
              + "</p><p>A shared passage.</p><div class='end'>All rights reserved.</div></article><div>Word {n}</div></body></html>")
    teaser = ("<html><body><article><a href='/x'>Also read {n}</a></article><div><p>" + story + "</p><p>More of " + story
              + "</p></div><div>Site slogan</div></body></html>")
    plain = "<html><body><div><p>" + story + "</p></div><div>Site slogan</div></body></html>"
    copied = "<html><body><article><h1>One title</h1><p>One text.</p></article></body></html>"
    rows = [(10 * h + k, f"http://{h}.example/{k}", page.format(n=k))
            for h, page in enumerate((shared, teaser, plain, copied)) for k in range(5)]
    rows += [(40 + k, f"http://4.example/{k}", copied if k < 3 else shared.format(n=k)) for k in range(6)]
    got = {r.page_id: r.text for r in page_text.extract_pages(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    for k in range(5):
        own = story.format(n=k)
        assert got[k] == f"Title {k}\n\n{own}\n\nA shared passage."
        assert got[10 + k] == f"Also read {k}\n\n{own}\n\nMore of {own}"
        assert got[20 + k] == own
        assert got[30 + k] == "One title\n\nOne text."
    assert got[40] == got[42] == "One title\n\nOne text."
    assert got[43].startswith("Title 3") and "Paragraph 3" in got[43]
