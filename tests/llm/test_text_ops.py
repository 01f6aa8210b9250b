import re

import numpy as np
import pyarrow as pa

import llm_cases as C
from teampulse.llm import html, licenses, lm, toxicity, vec

PAGE = """<!DOCTYPE html><html lang=en><head><title>T &amp; t</title><style>p{{}}</style><script>var a="</p><article>";</script>
</head><body class="blog"><header><a href=/>Site</a></header><nav><ul><li>Home<li>News</ul></nav><!-- <p>no</p> -->
<div class="ad">Buy {n}</div><article><header><h1>Title&nbsp;{n}</h1></header><p><b>Bold</b>ly said,
  line two &lt;here&gt;.<p>Unclosed &eacute;t&eacute; {n}<br>next<div class="promo-box">Same offer</div><div class=box>House style
box</div><ul><li>one<li>two {n}</ul><p>Shared line.</p><section class="comments"><p>First!</p></section></article>
<aside>Side</aside><form><input value=x>Mail</form><footer>&copy; me</footer></body>"""


def _text(n):
    return f"Title {n} Boldly said, line two <here>. Unclosed été {n} next one two {n} Shared line."


def _pages(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, host string")


def test_site_template_goes_and_the_article_stays(spark):
    rows = [(n, f"https://Blog.example.org/{n}", PAGE.format(n=n)) for n in range(12)]
    rows += [(100, "https://other.example.org/a", PAGE.format(n=100)), (101, None, None), (102, "nonsense", ""),
             (None, "http://x.example/", "<p>plain <i>words</i>"), (103, "https://x.example/b", "no <b markup at all > 5 & <")]
    got = {r.page_id: r for r in html.extracted(_pages(spark, rows)).collect()}
    assert len(got) == len(rows)
    for n in range(12):  # what is on every page of the host, box or line, is template
        assert got[n].text == f"Title {n} Unclosed été {n} next two {n}" and got[n].n_chars == len(got[n].text)
    assert got[100].text == _text(100).replace("next", "next House style box")  # one page shows no template
    assert (got[101].text, got[102].text, got[101].n_chars) == ("", "", 0)
    assert got[None].text == "plain words"
    assert html.extracted(_pages(spark, [])).collect() == []


def test_copies_of_a_page_keep_their_text(spark):
    rows = [(n, "https://h.example/x", "<body><div><div><p>All the text of this page.</p></div></div></body>") for n in range(9)]
    assert {r.text for r in html.extracted(_pages(spark, rows)).collect()} == {"All the text of this page."}


def test_copies_of_a_page_with_many_paragraphs_keep_them(spark):
    page = "<body>" + "".join(f"<p>Paragraph {k} of the page.</p>" for k in range(8)) + "</body>"
    rows = [(n, f"https://h.example/{n}", page) for n in range(9)]
    rows += [(20 + n, f"https://h.example/{20 + n}", f"<body><nav>{n}</nav><p>Own words of number {n}.</p><p>Paragraph 3 of the page.</p></body>")
             for n in range(1)]
    got = {r.page_id: r.text for r in html.extracted(_pages(spark, rows)).collect()}
    assert {got[n] for n in range(9)} == {" ".join(f"Paragraph {k} of the page." for k in range(8))}
    assert got[20] == "Own words of number 0. Paragraph 3 of the page."


def test_template_counts_pages_of_the_host(spark):
    box = "<div class=box>Box</div>"
    rows = [(n, f"http://a.example/{n}", f"<body>{box if n < k else ''}<p>Text number {n} is its own.</p></body>")
            for k, base in ((2, 0), (3, 50)) for n in range(base, base + 30)]
    rows = [(n, f"http://{'a' if n < 50 else 'b'}.example/{n}",
             f"<body>{box if n in (0, 1, 50, 51, 52) else ''}<p>Text number {n} is its own.</p></body>") for _, _, n in
            [(0, 0, r[0]) for r in rows]]
    got = {r.page_id: r.text for r in html.extracted(_pages(spark, rows)).collect()}
    assert got[0].startswith("Box") and got[50] == "Text number 50 is its own."


def _site(n, notice="<p>Our offices are closed on public holidays.</p>", host="h", flat=False):
    """A page whose article holds, unnamed, what the site puts on each page; its text differs from page to page."""
    rng = np.random.default_rng(n)
    own = [" ".join(f"w{x}" for x in rng.integers(0, 10**6, 12)) for _ in range(3)]
    body = f"<h1>Head {n}</h1><p>{own[0]}</p>{notice}<ul><li>{own[1]}</li><li>Ask us by mail</li></ul><table><tr><td>{own[2]}<td>Terms apply</table>"
    page = f"<body><div><div>{n} Menu</div><div>Top of the site</div></div><article>{body}</article><div>Bottom {n % 2}</div></body>"
    return page, " ".join([f"Head {n}", *own])


def test_unnamed_notices_in_articles_go_by_recurrence_alone(spark, monkeypatch):
    monkeypatch.setattr(html, "DROPPED_NAMES", frozenset())
    rows = [(n, f"http://h.example/{n}", _site(n)[0]) for n in range(30)]
    found = html.templates(_pages(spark, rows)).collect()
    assert {r.host for r in found} == {"h.example"} and len(found) >= 5
    for limit in (html.BROADCAST_HASHES, 0):  # both ways to bring the hashes to the pages
        got = {r.page_id: r.text for r in html.extracted(_pages(spark, rows), limit).collect()}
        assert got == {n: _site(n)[1] for n in range(30)}


def test_copies_with_edits_keep_what_they_share(spark):
    page, text = _site(1)
    rows = [(n, f"http://h.example/{n}", page.replace("Head 1", f"Head {n}")) for n in range(20)]
    got = {r.page_id: r.text for r in html.extracted(_pages(spark, rows)).collect()}
    assert all(got[n].startswith(f"Head {n} " + text.split(" ", 2)[2][:60]) for n in range(20))


def test_lines_that_a_tenth_of_the_pages_share_stay(spark):
    rows = [(n, f"http://h.example/{n}", _site(n, "<p>A saying that many quote.</p>" if n % 8 == 0 else "")[0]) for n in range(64)]
    got = {r.page_id: r.text for r in html.extracted(_pages(spark, rows)).collect()}
    assert all(("A saying that many quote." in got[n]) == (n % 8 == 0) for n in range(64))


def test_recurrence_equals_brute_force(spark):
    rows = [(n, f"http://{'ab'[n % 2]}.example/{n}", _site(n % 23)[0] if n % 5 else f"<div>{n % 3}<p>x {n // 2}</div>") for n in range(60)]
    pages = {}
    for _, url, page in rows:
        blocks, own = html.candidates(html.parse(page))
        host = pages.setdefault(url.split("/")[2], {})
        host.setdefault((None, False), set()).add(own)
        for b in blocks:
            host.setdefault((b.key, b.flow), set()).add(b.page)
    want = {(h, *k, len(v)) for h, found in pages.items() for k, v in found.items() if k[0] is None or len(v) >= html.MIN_PAGES}
    assert {tuple(r) for r in html.recurrences(_pages(spark, rows)).select("host", "hash", "flow", "n").collect()} == want


def test_recurring_blocks_are_found_on_the_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    assert html.templates(pages).count() > 0


def test_long_pages_are_read_whole(spark):
    body = "".join(f"<p>paragraph {n} of a long page</p>" for n in range(20_000))
    got = html.extracted(_pages(spark, [(1, "http://h.example/", f"<article>{body}</article>")])).first()
    assert got.n_chars == len(" ".join(f"paragraph {n} of a long page" for n in range(20_000)))


def test_odd_markup():
    assert html.main_text("<article>a</p>b</article>c", ()) == "a b"
    assert html.main_text("<main>x<script>y</main>", ()) == "x"
    assert html.main_text("<p>a<p hidden>b<p class='Cookie-Notice'>c<p id=main>d", ()) == "a d"
    assert html.main_text("<a " * 30_000, ()).count("<a") == 30_000
    assert html.main_text("<div>" * 20_000 + "deep", ()) == "deep"


def _near_license(rows):
    names = {"mit-notice": "Released under the MIT License", "apache-2.0-notice": "Licensed under the Apache License, Version 2.0",
             "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3"}
    return {(i, name, m.start(), m.end()) for i, t in rows for name, s in names.items() for m in re.finditer(re.escape(s), t or "")}


def test_license_lines_are_found_with_their_spans(spark):
    apache = licenses.TEMPLATES["apache-2.0-header"]
    rows = [*C.TEXTS, (20, "été Released under the MIT License. " * 3), (21, "x\nLicensed under the Apache License, Version 2.0.\ny"),
            (22, "Été " * 50 + "This work is licensed under the GNU General Public License, version 3." + C.LONG),
            (23, apache.replace("you may not use", "you shall never use").replace("License. You may", "License. And you may"))]
    got = licenses.license_spans(C.documents(spark, rows)).collect()
    full = {(r.doc_id, r.license, r.char_start, r.char_end) for r in got if r.coverage == 1 and r.license.endswith("notice")}
    assert _near_license(rows[:-1]) <= full
    edited = [r for r in got if r.doc_id == 23 and r.license == "apache-2.0-header"]
    assert len(edited) == 1 and 0.9 < edited[0].coverage < 1 and edited[0].char_start == 0
    assert not [r for r in got if r.doc_id in range(13)]
    assert licenses.license_spans(C.empty(spark)).collect() == []


def test_license_families_full_texts_and_parts_are_reported(spark):
    mpl, mit = licenses.TEMPLATES["mpl-2.0-text"].split(), licenses.TEMPLATES["mit-permission"].split()
    rows = [(1, "words Licensed under CC BY-NC 4.0. words"), (2, "Licensed under CC BY 4.0."), (3, " ".join(mpl)),
            (4, "mine " * 9 + " ".join(mpl[700:900]) + " yours" * 9), (5, " ".join(mit[:20])),
            (6, " ".join(mit[:14] + ["x"] * 30 + mit[44:]))]
    got = licenses.license_spans(C.documents(spark, rows)).collect()
    by = lambda i: {r.license: r for r in got if r.doc_id == i}
    assert by(1)["cc-by-nc-4.0-short-notice"].coverage == 1 and "cc-by-4.0-short-notice" not in by(1)
    assert by(2)["cc-by-4.0-short-notice"].coverage == 1 and "cc-by-nc-4.0-short-notice" not in by(2)
    assert by(3)["mpl-2.0-text"].coverage > 0.99
    part = by(4)["mpl-2.0-text"]
    assert 0 < part.coverage < 0.2 and part.char_start == 45 and part.char_end >= 45 + len(" ".join(mpl[700:900])) - 1
    assert 0.2 < by(5)["mit-permission"].coverage < 0.5
    assert len([r for r in got if r.doc_id == 6 and r.license == "mit-permission"]) == 2


PROSE = [
    "At the time of the harvest the village gathered by the river, and you may not use this bridge after dark.",
    "To the extent permitted by applicable law, the company refunds the price of any ticket that was not used.",
    "Lunch was served free of charge to any person who had helped with the hay, subject to the following conditions: be there.",
    "In no event shall the committee be liable for damages of any kind, and the terms and conditions of this agreement apply.",
    "The work is provided as is, without warranty of any kind, express or implied, said the seller of the old car.",
    "You may copy and distribute the leaflet in the school; a copy of this letter must be given to the head teacher.",
    "Redistribution of wealth, with or without modification of the tax law, is permitted provided that parliament agrees.",
    "The licence of the pub was renewed for a period of three years, as stated in the notice on the door.",
]


def test_prose_without_a_licence_has_no_match(spark):
    rows = [(i, t) for i, t in enumerate([*PROSE, " ".join(PROSE), C.PARAGRAPH * 3])]
    assert licenses.license_spans(C.documents(spark, rows)).collect() == []


def test_every_partial_copy_of_twenty_words_is_found(spark):
    rng = np.random.default_rng(4)
    rows, names = [], []
    for name, text in licenses.TEMPLATES.items():
        words = text.split()
        for at in rng.integers(0, len(words) - 20, 3).tolist() if len(words) > 20 else []:
            if sum(len(re.findall(r"[A-Za-z0-9]+", w)) for w in words[at:at + 20]) >= 20:
                rows.append((len(rows), "before it " + " ".join(words[at:at + 20]) + " after it"))
                names.append(name)
    found = {r.doc_id for r in licenses.license_spans(C.documents(spark, rows)).collect()}
    assert len(rows) > 60 and found == set(range(len(rows)))


def test_scan_equals_an_alignment_with_every_template():
    """The index loses nothing: every template that reaches the bounds by full alignment is reported."""
    few = {k: licenses.TEMPLATES[k] for k in ("mit-permission", "apache-2.0-header", "isc-permission", "mit-notice", "cc-by-4.0-notice")}
    index, rng = licenses.Index(few), np.random.default_rng(6)
    for case in range(25):
        name = list(few)[case % len(few)]
        words = few[name].split()
        for _ in range(case % 4):
            words[int(rng.integers(len(words)))] = "changed"
        low = int(rng.integers(0, max(1, len(words) - 25))) if case % 2 else 0
        raw = np.frombuffer(("some words before " + " ".join(words[low:]) + " and some after").encode(), np.uint8)
        h = licenses.word_hashes(raw, np.array([0, len(raw)]))[0]
        got = {index.names[m[0]] for m in licenses.scan(index, h)}
        for t, template in enumerate(index.words):
            score, matched, begin, end = licenses.scored(h.tolist(), template, 0, len(h) + len(template))
            if (score >= licenses.PART or matched >= licenses.COVERAGE * len(template)) and score >= 6 and index.names[t] == name:
                assert name in got


def test_winnowing_keeps_one_of_every_window():
    g = np.random.default_rng(1).integers(0, 50, 200).astype(np.uint64)
    at = set(licenses.winnowed(g, 4).tolist())
    assert all(at & set(range(i, i + 4)) for i in range(len(g) - 3))


def test_alignment_matches_full_dynamic_programming():
    rng = np.random.default_rng(2)
    for _ in range(30):
        template = rng.integers(0, 6, 14).astype(np.uint64)
        text = np.delete(template, rng.integers(0, 14, 2))
        text = np.insert(text, rng.integers(0, 10), 9)
        best = np.zeros((len(template) + 1, len(text) + 1))
        for i in range(1, len(template) + 1):
            for j in range(1, len(text) + 1):
                same = 1 if template[i - 1] == text[j - 1] else -1
                best[i, j] = max(0, best[i - 1, j - 1] + same, best[i - 1, j] - 1, best[i, j - 1] - 1)
        matched, begin, end = licenses.align(text.tolist(), template, 0, band=20)
        assert matched >= best.max() and 0 <= begin < end <= len(text)


def _two_tongues(n=120):
    rng = np.random.default_rng(7)
    good, bad = [f"good{k}" for k in range(60)], [f"junk{k}" for k in range(60)]
    rows, marks = [], []
    for i in range(n):
        words = rng.choice(good if i % 3 else bad, 80)
        rows.append((500 + i, " ".join(words)))
        marks.append((500 + i, int(bool(i % 3)), 0))
    return rows, marks


def test_cross_entropy_difference_separates_held_out_documents(spark):
    rows, marks = _two_tongues()
    rows += C.TEXTS + [(None, "good1 good2"), (500, "junk1 junk2 junk3 junk4")]
    train = [m for m in marks if m[0] % 4]
    got = lm.cross_entropy_difference(C.documents(spark, rows), C.labels(spark, [*train, (None, 1, 0), (3, None, None)])).collect()
    assert len(got) == len(rows)
    score = {r.doc_id: r.score for r in got if r.n_words == 80}
    held = [m for m in marks if not m[0] % 4]
    assert max(score[i] for i, q, _ in held if q) < min(score[i] for i, q, _ in held if not q)
    assert all(r.score == r.target_bits == 0 for r in got if r.n_words == 0)
    assert all(abs(r.score - (r.target_bits - r.background_bits)) < 1e-9 for r in got)
    assert lm.cross_entropy_difference(C.empty(spark), C.labels(spark)).collect() == []


def test_lm_losses_match_a_plain_count():
    texts = ["a b a b c", "b a", "", "a"]
    data, offsets = vec.buffers(pa.array(texts))
    w, p, first = lm.entries(data, offsets)
    total = np.zeros((2, (1 << lm.WORD_BITS) + (1 << lm.PAIR_BITS)))
    for k, rows in enumerate(([0], [0, 1, 2, 3])):
        own = np.isin(np.repeat(np.arange(4), np.diff(first)), rows)
        np.add.at(total[k], w[own], 1)
        np.add.at(total[k], p[own] + (1 << lm.WORD_BITS), 1)
    table = pa.table({"entry": np.flatnonzero(total[1]), "target": total[0, total[1] > 0], "background": total[1, total[1] > 0]})

    class Counted:
        def toArrow(self):
            return table

    model = lm.losses(Counted())
    n, target, background = lm.document_losses(model, data, offsets)
    words, v = [t.split() for t in texts], 1 << lm.WORD_BITS
    scale = 5 / 8
    for k, (rows, f, got) in enumerate((([0], 1, target), ([0, 1, 2, 3], scale, background))):
        uni, bi = {}, {}
        for r in rows:
            for i, x in enumerate(words[r]):
                uni[x] = uni.get(x, 0) + f
                if i:
                    bi[words[r][i - 1], x] = bi.get((words[r][i - 1], x), 0) + f
        size = sum(uni.values())
        p1 = lambda x: (uni.get(x, 0) + 1) / (size + v)
        for r, ws in enumerate(words):
            bits = [-np.log2(p1(x) if not i else (bi.get((ws[i - 1], x), 0) + lm.MIX * p1(x)) / (uni.get(ws[i - 1], 0) + lm.MIX))
                    for i, x in enumerate(ws)]
            assert abs(got[r] - (np.mean(bits) if bits else 0)) < 1e-4


def test_lm_counts_every_word_and_pair_of_a_growing_vocabulary(spark):
    rng = np.random.default_rng(11)
    rows = [(i, " ".join(f"w{k}" for k in rng.integers(0, 40_000, 600))) for i in range(120)] + [(None, "w1 w2"), (3, "w5 w6 w5")]
    aimed = {i for i in range(120) if i % 3}
    texts, sums = [t.split() for _, t in rows], []
    for own in (aimed, None):
        uni, bi = {}, {}
        for (i, _), ws in zip(rows, texts):
            for u, w in zip([None, *ws], ws) if own is None or i in own else ():
                uni[w] = uni.get(w, 0) + 1
                bi[u, w] = bi.get((u, w), 0) + 1
        sums.append((uni, bi, sum(uni.values())))
    v, f = len(sums[1][0]), sums[0][2] / sums[1][2]
    want = []
    for (i, _), ws in zip(rows, texts):
        means = []
        for (uni, bi, size), scale in zip(sums, (1, f)):
            p = [(uni.get(w, 0) * scale + 1) / (size * scale + v) for w in ws]
            bits = [-np.log2(p[0])] + [-np.log2((bi.get((u, w), 0) * scale + lm.MIX * q) / (uni.get(u, 0) * scale + lm.MIX))
                                       for u, w, q in zip(ws, ws[1:], p[1:])]
            means.append(np.mean(bits))
        want.append((str(i), len(ws), *means))
    got = lm.cross_entropy_difference(C.documents(spark, rows), C.labels(spark, [(i, 1, 0) for i in aimed])).collect()
    got = sorted((str(r.doc_id), r.n_words, r.target_bits, r.background_bits) for r in got)
    assert [g[:2] for g in got] == [w[:2] for w in sorted(want)]
    assert np.allclose([g[2:] for g in got], [w[2:] for w in sorted(want)], rtol=0, atol=1e-9)


def _insults(n=400):
    rng = np.random.default_rng(5)
    plain = [f"plain{k}" for k in range(300)]
    rows, marks = [], []
    for i in range(n):
        words = list(rng.choice(plain, 40))
        toxic = i % 5 == 0
        if toxic:
            words[3:5] = [str(rng.choice(["moronic", "vilescum"])), "insultum" + str(rng.integers(0, 9))]
        rows.append((i, " ".join(words)))
        marks.append((i, 1, int(toxic)))
    return rows, marks


def test_toxicity_on_held_out_rows(spark):
    import zlib

    rows, marks = _insults()
    docs = C.documents(spark, [*rows, *((1000 + i, t) for i, t in C.TEXTS), (None, "plain1"), (7, "plain2")])
    wrong = [(i, q, 1 - t) if zlib.crc32(str(i).encode()) % 4 == 2 else (i, q, t) for i, q, t in marks]
    a = toxicity.toxicity(docs, C.labels(spark, [*marks, (None, 1, 1)])).collect()
    b = toxicity.toxicity(docs, C.labels(spark, [*wrong, (3000, 1, None)])).collect()
    key = lambda rows: sorted(map(tuple, rows), key=str)
    assert key(a) == key(b)  # labels of held-out rows change nothing
    got = {r.doc_id: r for r in a}
    held = [(i, t) for i, _, t in marks if got[i].held_out]
    assert len(a) == 400 + len(C.TEXTS) + 2 and len(held) > 60
    assert np.mean([got[i].predicted == t for i, t in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in a)
    assert got[1003].score == got[1002].score and not got[None].held_out
    kept = toxicity.keep_clean(docs, C.labels(spark, marks))
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.predicted == 0 for r in a)


def test_toxicity_without_labels_and_empty(spark):
    got = toxicity.toxicity(C.documents(spark), C.labels(spark)).collect()
    assert len(got) == len(C.TEXTS) and {r.predicted for r in got} == {0}
    assert toxicity.toxicity(C.empty(spark), C.labels(spark)).collect() == []


def test_machine_learns_a_pair_that_single_terms_miss():
    rng = np.random.default_rng(1)
    row, at, y = [], [], []
    for i in range(1200):  # toxic only where both terms meet
        a, b = rng.integers(0, 2, 2)
        for t, here in enumerate((a, b)):
            if here:
                row.append(i)
                at.append(t)
        y.append(int(a != b))
    row, at = np.array(row), np.array(at)
    model = toxicity.fit(np.array([1, 2], np.uint64), row, at, np.array(y), 0.5, epochs=60)
    pairs = {(): 0, (0,): 1, (1,): 1, (0, 1): 0}
    for terms, want in pairs.items():
        got = toxicity.raw_scores(model, np.zeros(len(terms), np.int64), np.array(terms, np.int64), 1)[0]
        assert (got > 0) == bool(want)
