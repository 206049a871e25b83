"""Decontamination, main text, PII surrogates, quality and licences."""

import html
import ipaddress
import random
import re

import pytest
from llm_cases import clashing, documents, odd_documents, prose

from storepulse.llm import decontamination as dc
from storepulse.llm import html_text, licenses, pii, quality

# ---- decontamination -----------------------------------------------------------


def plain_hits(text, items, window=10):
    """(n_words, hit word numbers, item names) by comparing every place with every window."""
    def words(t):
        lowered = (t or "").translate({c: c + 32 for c in range(65, 91)})
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)

    own, hits, names = words(text), set(), set()
    for name, item in items:
        w = words(item)
        for i in range(max(1, len(w) - window + 1)) if w else ():
            part = w[i : i + window]
            for at in range(len(own) - len(part) + 1):
                if own[at : at + len(part)] == part:
                    hits |= set(range(at, at + len(part)))
                    names.add("" if name is None else str(name))
    return len(own), hits, names


ITEMS = [(1, prose(70, 25)), (2, prose(71, 4)), (2, prose(72, 12)), (10, "Zürich ist GROSS, 3-mal"), (None, prose(73, 11)), (5, ""), (6, None), (1, prose(70, 25))]


def leak_documents():
    mark = prose(70, 25).split()
    return [
        *odd_documents(),
        (50, "pre " + prose(70, 25).upper() + "! post"), (51, " ".join(mark[3:14]) + " " + " ".join(mark[14:20])),
        (52, " ".join(mark[:9])), (53, "x " + prose(71, 4) + " " + prose(71, 4)), (54, "in zürich ist gross 3 mal, ZÜRICH"),
        (55, prose(73, 11) + "\n" + prose(72, 12)), (56, "a, zürich; ist...gross 3\nMAL"), (57, prose(1, 60_000) + " " + prose(72, 12)),
    ]


@pytest.mark.parametrize("most", [dc.MAX_WORDS, 60])
def test_leaks_against_plain_search(spark, most):
    rows = leak_documents()
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = dc.find_leaks(clashing(documents(spark, rows)), bench, max_words=most)
    got = sorted(((str(r.doc_id), r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in out.collect()), key=str)
    want = []
    for i, text, *_ in rows:
        n, hits, names = plain_hits(text, ITEMS)
        want.append((str(i), n, len(hits), tuple(sorted(names)), bool(hits)))
    assert got == sorted(want, key=str)


def test_spans_are_of_the_original(spark):
    text = "Ünï — Zürich IST... Gross, 3 mal! Ende"
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    r = dc.find_leaks(documents(spark, [(1, text)]), bench).first()
    assert [text[s["start"] : s["end"]] for s in r.spans] == ["Zürich IST... Gross, 3 mal"]


def test_no_benchmark_and_no_documents(spark):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in dc.find_leaks(documents(spark, odd_documents()), empty).collect())
    assert dc.find_leaks(documents(spark, []), empty).collect() == []


def test_clean_rows_stay_whole(spark):
    df = clashing(documents(spark, leak_documents()))
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = dc.without_leaks(df, bench)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} & {50, 51, 53, 54, 55, 56, 57} == set()
    assert kept.count() == len(leak_documents()) - 7


# ---- main text -----------------------------------------------------------------


def page_of(blocks, rng, marked=True):
    """A page around an article whose text is known."""
    words = lambda n: prose(rng.random(), n)
    body = "".join(f"<p class='x'>{html.escape(b)}</p>\n  " if rng.random() < 0.7 else f"<div><b>{html.escape(b)}</b></div>" for b in blocks)
    article = f"<article id=a>{body}</article>" if marked else f"<div class='content'>{body}</div>"
    return (
        f"<!DOCTYPE html><html><head><title>{words(5)}</title><style>p > b {{x:1}}</style></head><body class='has-sidebar'>"
        f"<header><h1>{words(3)}</h1></header><nav><ul>{''.join(f'<li><a href=/{i}>{words(2)}</a></li>' for i in range(8))}</ul></nav>"
        f"<!-- <p>{words(40)}</p> --><div class=\"ad banner\"><div>{words(12)}</div></div><script>var t='</p><article>';</script>"
        f"{article}<section class='comments'><p>{words(50)}</p><p>{words(50)}</p></section><aside>{words(30)}</aside>"
        f"<form><label>{words(3)}</label><textarea><p>{words(9)}</p></textarea></form><div id='cookie-notice'>{words(20)}</div>"
        f"<footer>&copy; {words(6)}</footer>" + ("</body></html>" if rng.random() < 0.5 else "")
    )


@pytest.mark.parametrize("marked", [True, False])
def test_known_articles(spark, marked):
    rng = random.Random(11)
    pages, want = [], {}
    for i in range(40):
        blocks = [prose(100 * i + k, rng.randint(12, 60)) + " & <ü> \"x\"" for k in range(rng.randint(2, 6))]
        if marked:
            blocks.insert(0, prose(i, 2))
        pages.append((i, f"http://h/{i}", page_of(blocks, rng, marked)))
        want[i] = "\n".join(blocks)
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    out = {r.page_id: r for r in html_text.extract(df).collect()}
    for i, text in want.items():
        assert out[i].text == text and out[i].n_chars == len(text)


def test_blocks_and_references():
    page = "<article><h1>A&nbsp;&amp;  B</h1>one<br>two\n three<p>x &lt;y&gt; &#233;&#x1F600; &copy 1<p>&bogus; a < b <em>c</em>d<ul><li>i</li><li> </li></ul></article>"
    assert html_text.main_text(page) == "A & B\none two three\nx <y> é😀 © 1\n&bogus; a < b cd\ni"


def test_article_in_pieces_and_broken_markup():
    assert html_text.main_text("<main><p>a<div class=ad>buy</div><p>b<div class='ad'>c") == "a\nb"
    assert html_text.main_text("<nav><a>x</a><article>kept</article>") == "kept"
    assert html_text.main_text("<p>unclosed <!-- comment") == "unclosed"
    assert html_text.main_text("plain text only") == "plain text only"
    assert html_text.main_text("<script>never closed") == "" and html_text.main_text("<p title='x") == ""
    long = prose(1, 40_000)
    assert html_text.main_text(f"<article><p>{long}</p></article>") == long


@pytest.mark.parametrize("marked", [True, False])
def test_comment_articles_go_and_closing_paragraph_stays(marked):
    body, closing = prose(1, 60), "Read on tomorrow."
    tag = "article" if marked else "div"
    comment = f"<article class='comment' id=comment-7><p>{prose(2, 40)}</p></article>"
    story = f"<{tag}><p>{body}</p><div class=ad>buy</div><p>{closing}</p></{tag}>"
    for section in (f"<section class=comments>{comment}<div>{comment}</div></section>", f"<section>{comment}</section>"):
        assert html_text.main_text(f"<body>{story}{section}</body>") == f"{body}\n{closing}"
    assert html_text.main_text(f"<aside>{prose(3, 30)}<article>{prose(4, 30)}</article></aside>{story}") == f"{body}\n{closing}"


def test_windows_decide_inside_articles():
    ad, long = "<div class=ad>x</div>", prose(5, 60)
    page = f"<article><p>{long}</p>{ad}<p>beside</p>{ad}<p>far</p>{ad}<p>alone</p></article><article><p>teaser</p></article>"
    assert html_text.main_text(page) == f"{long}\nbeside"


def test_articles_in_misnamed_frames_are_found():
    text = prose(6, 40)
    assert html_text.main_text(f"<div class=with-sidebar><article>{text}</article></div>") == text
    assert html_text.main_text(f"<article class=notice>{text}</article>") == text
    assert html_text.main_text(f"<article class='post comments-open'>{text}</article><p>{prose(7, 40)}</p>") == text
    assert html_text.main_text(f"<nav><a>x</a></nav><div class=menu>x<main>{text}</main></div>") == text


def test_pages_odd(spark):
    rows = [(1, None, None), (2, "u", ""), (None, "u", "<article>t</article>"), (3, "u", "<nav>x</nav>"), (3, "u", "<nav>x</nav>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'own' AS text", "1 AS extra")
    out = html_text.extract(df).collect()
    assert sorted((str(r.page_id), r.text, r.n_chars, r.extra) for r in out) == [("1", "", 0, 1), ("2", "", 0, 1), ("3", "", 0, 1), ("3", "", 0, 1), ("None", "t", 1, 1)]
    assert html_text.extract(df.limit(0)).collect() == []


# ---- PII -------------------------------------------------------------------------

KEY = pii.tweaked("test", 0)


@pytest.mark.parametrize("kind,values", [
    ("ip", [f"10.0.{i}.{j}" for i in range(12) for j in range(12)] + [f"93.184.{i}.7" for i in range(100)]),
    ("phone", [f"+1 (168) 555-{i:04d}" for i in range(300)]),
    ("card", [f"411111111111{i:04d}" for i in range(300)]),
    ("email", [f"ab{i}.cd@mail{j}.example.com" for i in range(40) for j in range(5)]),
    ("secret", [f"{i:018x}" for i in range(200)] + [f"S3cret{i:03d}" for i in range(100)]),
    ("ssn", [f"123-45-{i:04d}" for i in range(200)]),
    ("name", [f"Margaret {a}{b}rt" for a in "BCDFG" for b in "aeiou"] + ["Екатерина Петрова", "Maria Süß-Krüger", "Wolfgang"]),
])
def test_surrogates_keep_form_and_are_distinct(kind, values):
    made = [pii.surrogate(kind, v, KEY) for v in values]
    assert len(set(made)) == len(set(values))
    assert all(a != b for a, b in zip(made, values))
    assert made == [pii.surrogate(kind, v, KEY) for v in values] != [pii.surrogate(kind, v, pii.tweaked("test", 1)) for v in values]
    if kind not in ("name", "ip"):
        shape = lambda t: re.sub(r"[^\W\d_]", "a", re.sub(r"\d", "9", t)) if kind != "secret" else len(t)
        assert [shape(m) for m in made] == [shape(v) for v in values]
    if kind == "ip":
        private = lambda t: ipaddress.ip_address(t).is_private
        assert sum(private(m) != private(v) for m, v in zip(made, values)) <= 1  # some reserved ranges are no class
    if kind == "card":
        assert [pii._luhn(m) == 0 for m in made] == [pii._luhn(v) == 0 for v in values]


def test_gender_script_and_coreference():
    for (gender, script), names in pii.GIVEN.items():
        made = {pii.surrogate("name", n, KEY) for n in names}
        assert made == set(names) and all(pii.surrogate("name", n, KEY) != n for n in names), (gender, script)
    text = "Mail Anna.B@Mail1.example.com, then anna.b@mail1.example.com. Mrs. Margaret Kohl met Margaret Kohl and MR. X."
    new, made = pii.replaced(text, KEY)
    assert len(made) == 4 and made[0][2].lower() == made[1][2].lower() and made[2][2] == made[3][2]
    assert "Anna" not in new and "Kohl" not in new and new.startswith("Mail ") and "Mrs. " in new
    assert re.search(r"[а-яё]", pii.surrogate("name", "Екатерина Петрова", KEY)) and pii.surrogate("email", "ABc@X.org", KEY)[:2].isupper()


def test_clean_text_is_unchanged():
    for text in ("version 2.0 of 2024-01-02 at 10:30", prose(4, 500), "1.2.3.4.5 and 12345", "a@b", "De Der Des. token of", ""):
        assert pii.replaced(text, KEY) == (text, [])


def test_pii_table(spark):
    rows = [*odd_documents(), (60, "call +1 (168) 555-5254 or 49.37.233.206"), (61, "+1 (168) 555-5254"), (61, "+1 (168) 555-5254")]
    df = clashing(documents(spark, rows))
    out = pii.surrogates(df)
    assert set(out.columns) == set(df.columns)
    got = {}
    for r in out.collect():
        got.setdefault(r.doc_id, []).append((r.text, r.n_entities, r.score))
    assert got[1] == [(None, 0, "own score")] and got[2][0][0] == "" and got[5][0][0] == prose(1, 60_000)
    assert got[60][0][1] == 2 and got[61][0] == got[61][1] and got[61][0][0] in got[60][0][0]
    assert pii.collisions(documents(spark, rows), KEY) == {}
    assert pii.surrogates(documents(spark, [])).collect() == []


def test_collisions_are_found(spark, monkeypatch):
    monkeypatch.setattr(pii, "surrogate", lambda kind, entity, key: "1.1.1.1")
    assert pii.collisions(documents(spark, [(1, "8.8.8.8 9.9.9.9")]), KEY) == {"ip": 1}
    with pytest.raises(ValueError, match="collide under"):
        pii.surrogates(documents(spark, [(1, "8.8.8.8 9.9.9.9")]))


def test_pii_ends_on_text_that_no_surrogate_changes(spark):
    rows = [(1, "password: ________"), (2, "token=-------- and secret: __--__--__"), (3, "from 01.2.3.4 to 1.2.3.4"), (4, "password: hunter2hunter2")]
    out = {r.doc_id: (r.text, r.n_entities) for r in pii.surrogates(documents(spark, rows)).collect()}
    assert out[1] == (rows[0][1], 0) and out[2] == (rows[1][1], 0)
    made = re.findall(r"[\d.]{7,}", out[3][0])
    assert len(made) == 2 and len(set(made)) == 1 and made[0] != "1.2.3.4"
    assert out[4][1] == 1 and "hunter2" not in out[4][0]


def test_pii_distinct_over_a_table_by_brute_force(spark):
    import os

    from conftest import SF01

    docs = spark.read.parquet(os.path.join(SF01, "documents.parquet")).select("doc_id", "text")
    known, by = {}, {}
    for r in docs.collect():
        for kind, entity, new in pii.replaced(r.text or "", pii.tweaked(pii.KEY, 0))[1]:
            was, now = pii.canonical(kind, entity), pii.canonical(kind, new)
            assert was != now and known.setdefault((kind, was), now) == now and by.setdefault((kind, now), was) == was
    assert len(known) > 50 and pii.collisions(docs, pii.tweaked(pii.KEY, 0)) == {}


# ---- quality ---------------------------------------------------------------------


def sentences(seed, n):
    rng = random.Random(seed)
    return " ".join(prose(rng.random(), rng.randint(5, 12)).capitalize() + "." for _ in range(n))


def junk(seed):
    words = prose(seed, 60).split()
    return [
        " ".join(w for w in words[:8] for _ in range(9)), " | ".join(words), " ".join(w + "$$$" for w in words), " ".join(w.upper() + "!!" for w in words),
    ][seed % 4]


def test_estimate_finds_planted_accuracies():
    rng = random.Random(3)
    counts, truth = {}, {}
    for _ in range(4000):
        good = rng.random() < 0.8
        p = "".join(("g" if (rng.random() < a) == good else "b") if rng.random() < 0.9 else "-" for a in (0.95, 0.9, 0.8, 0.7))
        counts[p] = counts.get(p, 0) + 1
        truth[p] = truth.get(p, 0) + good
    chances, share, posterior = quality.estimate(counts)
    assert abs(share - 0.8) < 0.05
    right = chances[1, :, 0] / chances[1, :, :2].sum(axis=1)
    assert [round(float(x), 1) for x in right] == pytest.approx([0.95, 0.9, 0.8, 0.7], abs=0.06)
    assert all(abs(posterior[p] - truth[p] / n) < 0.15 for p, n in counts.items() if n > 100)


def test_junk_goes_and_prose_stays(spark):
    rows = [(i, sentences(i, 8)) for i in range(300)] + [(1000 + i, junk(i)) for i in range(80)]
    out = {r.doc_id: r for r in quality.classify(documents(spark, rows), sample=300).collect()}
    assert all(out[i].keep for i in range(300))
    assert sum(not out[1000 + i].keep for i in range(80)) >= 78


def test_quality_odd(spark):
    df = clashing(documents(spark, odd_documents()))
    out = quality.classify(df).collect()
    assert len(out) == len(odd_documents())
    assert all(not r.keep and r.score == 0 for r in out if r.doc_id in (1, 2, 3))
    assert quality.classify(documents(spark, [])).collect() == []


# ---- licences ----------------------------------------------------------------------


def test_templates_find_themselves():
    templates = licenses.Templates({}, 1000)
    for name, texts in licenses.TEMPLATES.items():
        for text in texts:
            found, score = templates.best(text)
            assert found == name and score == pytest.approx(1), text


def test_inheritance_by_nearest_ancestor(spark):
    mit, gpl, apache = (licenses.TEMPLATES[k][0] for k in ("MIT", "GPL-3.0", "Apache-2.0"))
    files = [
        ("LICENSE", mit), ("readme", prose(1, 50)), ("a/x.c", prose(2, 50)), ("a/b/COPYING", "Terms.\n" + gpl), ("a/b/c/d.c", None),
        ("a/b/c/e.c", f"// {apache}\n{prose(3, 40)}"), ("other/f.c", ""), ("a/b/c/d.c", None), (None, prose(4, 20)), (None, apache),
        ("a/bb/x", "/* Licensed under the Apache\n * License, Version 2.0. */\n" + prose(5, 300)),
    ]
    df = spark.createDataFrame(files, "path string, text string")
    out = {}
    for r in licenses.scan(df).collect():
        out.setdefault(r.path, []).append((r.license, r.origin, r.license_path))
    assert out["LICENSE"] == [("MIT", "file", "LICENSE")] and out["readme"] == [("MIT", "inherited", "LICENSE")]
    assert out["a/x.c"] == out["other/f.c"] == [("MIT", "inherited", "LICENSE")]
    assert out["a/b/COPYING"] == [("GPL-3.0", "file", "a/b/COPYING")]
    assert out["a/b/c/d.c"] == [("GPL-3.0", "inherited", "a/b/COPYING")] * 2
    assert out["a/b/c/e.c"] == [("Apache-2.0", "header", "a/b/c/e.c")] and out["a/bb/x"][0][:2] == ("Apache-2.0", "header")
    assert sorted(out[None], key=str) == [("Apache-2.0", "file", None), (None, "none", None)]


def test_licences_odd(spark):
    docs = documents(spark, odd_documents())
    out = licenses.scan(licenses.document_files(clashing(docs)))
    assert out.count() == len(odd_documents()) and {r.license for r in out.collect()} == {None}
    assert licenses.scan(licenses.document_files(documents(spark, []))).collect() == []


def test_weak_labels_read_each_word_once(monkeypatch):
    """Shapes are found for new words only, and remembered words give what fresh ones give."""
    read, shapes_of = [], quality.shapes_of
    monkeypatch.setattr(quality, "shapes_of", lambda text: read.append(text) or shapes_of(text))
    texts = ["One two  two, THREE!!! 44\x1cfive\u00a0six \u039f\u0394\u039f\u03a3 x", "two, One \u00a0 six aaaa", "One two  two, THREE!!! 44\x1cfive\u00a0six \u039f\u0394\u039f\u03a3 x"] * 3
    one = quality.Reader(14)
    got = [one(t) for t in texts]
    assert sorted(" ".join(read).split()) == sorted(set(" ".join(texts).split()))
    for text, (votes, slots, values) in zip(texts, got, strict=True):
        fresh = quality.Reader(14)(text)
        assert votes == fresh[0] == quality.Reader(14, scored=False).votes(text)
        assert slots.tolist() == fresh[1].tolist() and values.tolist() == fresh[2].tolist()
    assert [quality.Reader(14)(t)[0] for t in (None, "", " \n")] == ["." * len(quality.LABELLERS)] * 3
