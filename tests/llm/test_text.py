import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_data import prose

from lakemoor.llm import html_extract, quality, toxicity
from lakemoor.llm.html_extract import blocks, entropies, extract_text, feature_counts, host_of, page_text
from lakemoor.llm.licenses import ANCHORS, BASE, NOTICES, rules, scan_licenses
from lakemoor.llm.linear import cumulative_link, logistic, minimise, sigmoid


def expected(text):
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)
    places, base = [], set()
    for phrase, label in BASE.items():
        k = phrase.split()
        found = [i for i in range(len(w)) if w[i : i + len(k)] == k]
        places += found
        base |= {label} if found else set()
    low = f" {' '.join(w)} "
    found = sorted((m.start(), -m.end(), p, i, label) for i, p, _, _, x, _, label in rules() for m in re.finditer(f"(?<= )(?:{x})(?= )", low))
    kept = [d for n, d in enumerate(found) if not any(c[1] <= d[1] and c[2] <= d[2] for c in found[:n])]
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(base | {d[4] for d in kept}))


def test_licenses(frame, odd_docs):
    lines = ["Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "SPDX-License-Identifier: GPL-3.0-or-later", "under the mit license " * 50, "Creative Commons Attribution-NonCommercial 4.0 License", "All rights reserved. Copyright (c) 2020", "Licensed under CC BY-NC 4.0.", "under the K mit license", "UNDER THE MIT LICENSE", "cc by nc nd 4 0"]
    rows = [*odd_docs, *((300 + i, x) for i, x in enumerate(lines)), *((400 + i, prose(i, 300) + " " + x + " " + prose(i + 50, 30)) for i, x in enumerate(lines))]
    got = scan_licenses(frame(rows))
    texts = defaultdict(list)
    for r in got.collect():
        texts[r.doc_id].append((r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
    want = defaultdict(list)
    for i, t in rows:
        want[i].append(expected(t))
    assert {k: Counter(v) for k, v in texts.items()} == {k: Counter(v) for k, v in want.items()}
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan.split("Physical Plan")[1].replace("Exchange RoundRobin", "").replace("Exchange SinglePartition", "")


def test_many_matches_in_one_text(frame):
    """More matches than a block holds, some contained in others across blocks."""
    parts = ["licensed under the mit license", "cc by nc 4 0", "all rights reserved", "released under the gnu gpl version 3", "copyright c 2020", "bsd license", "and so on"]
    rows = [(i, " ".join(parts[(j * (i + 3) + j // 7) % 7] for j in range(150 * i))) for i in range(1, 5)]
    found = {r.doc_id: r for r in scan_licenses(frame(rows)).collect()}
    for i, t in rows:
        low = f" {t} "
        every = sorted((m.start(), -m.end(), p, k, label) for k, p, _, _, x, _, label in rules() for m in re.finditer(f"(?<= )(?:{x})(?= )", low))
        kept = [d for n, d in enumerate(every) if not any(c[1] <= d[1] and c[2] <= d[2] for c in every[:n])]
        assert len(kept) > 64 and [(d.start, d.end, d.label) for d in found[i].detections] == [(b, -e, label) for b, e, _, _, label in kept]


def test_rules_have_anchors_and_hundreds():
    assert len(rules()) > 400 and len(NOTICES) > 100 and len({r[4:] for r in rules()}) == len(rules())
    for line in ("spdx license identifier mit", "licensed under the mit license", "all rights reserved", "permission is hereby granted free of charge to any person obtaining a copy"):
        assert any(a in line for a in ANCHORS)


def spellings(x, seed):
    """A text that the expression matches, its choices made by ``seed``."""
    rng = np.random.default_rng(seed)

    def made(parsed):
        out = ""
        for op, v in parsed:
            name = str(op)
            if name == "LITERAL":
                out += chr(v)
            elif name == "IN":
                kind, one = v[int(rng.integers(len(v)))]
                out += chr(int(rng.integers(one[0], one[1] + 1)) if str(kind) == "RANGE" else one)
            elif name == "BRANCH":
                out += made(v[1][int(rng.integers(len(v[1])))])
            elif name == "SUBPATTERN":
                out += made(v[3])
            else:
                assert name == "MAX_REPEAT"
                out += "".join(made(v[2]) for _ in range(int(rng.integers(v[0], v[1] + 1))))
        return out

    text = made(re._parser.parse(x))
    assert re.fullmatch(x, text)
    return text


def test_rules_pass_their_own_keywords():
    for i, _, k1, k2, x, _, label in rules():
        for seed in range(60):
            text = f" {spellings(x, 100 * i + seed)} "
            assert k1 in text and k2 in text, (label, x, text)


def test_no_rule_is_kept_out_by_the_anchors():
    lines = ["released under mit", "distributed under the bsd", "available under isc", "published under mpl 2 0", "under the terms of the eupl"]
    lines += [spellings(x, 100 * i + seed) for i, _, _, _, x, _, _ in rules() for seed in range(60)] + list(BASE)
    assert not [x for x in lines if not any(a in f" {x} " for a in ANCHORS)]


def test_spdx_identifiers(frame):
    lines = ["EPL-2.0", "CDDL-1.0", "GFDL-1.3", "BSL-1.0", "PSF-2.0", "OFL-1.1", "ODbL-1.0", "MS-PL", "MS-RL", "UPL-1.0", "AFL-3.0", "OSL-3.0", "SSPL-1.0", "BUSL-1.1"]
    rows = [(i, f"SPDX-License-Identifier: {x}") for i, x in enumerate(lines)]
    got = {r.doc_id: r for r in scan_licenses(frame(rows)).collect()}
    for i, text in rows:
        assert got[i].labels == expected(text)[5] != "" and got[i].score == 1.0


def labelled(spark, n, bad, column, longer=False):
    """Every fourth text holds a bad word; longer: these alone have more words of other kinds, too."""
    rows = [(i, prose(i, 60) + (" " + bad(i) + " " + prose(i + 9999, 20) if i % 4 == 0 else "" if longer else " " + prose(i + 9999, 21))) for i in range(n)]
    labels = [(i, int(i % 4 == 0)) for i in range(n)]
    return rows, spark.createDataFrame(labels, f"doc_id long, {column} int")


def test_toxicity(spark, frame, odd_docs):
    rows, labels = labelled(spark, 600, lambda i: ["grumblefex", "snorkwart", "grumblefix"][i % 3], "toxic")
    docs = frame(rows)
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].predicted == int(i % 4 == 0) == int(got[i].score >= 0.5) for i in held)
    flipped = labels.withColumn("toxic", toxicity.F.when(toxicity.held_out("doc_id"), 1 - toxicity.F.col("toxic")).otherwise(toxicity.F.col("toxic")))
    again = toxicity.fit(docs, flipped)
    assert np.array_equal(model.weights, again.weights) and model.intercept == again.intercept  # held-out labels are not read
    kept = toxicity.keep_clean(docs, labels)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [i for i in range(600) if i % 4]
    odd = toxicity.score(frame(odd_docs), model).collect()
    assert len(odd) == len(odd_docs) and all(0 <= r.score <= 1 for r in odd)
    rows, labels = labelled(spark, 600, lambda i: ["grumblefex", "snorkwart", "grumblefix"][i % 3], "toxic", longer=True)
    scored = toxicity.score(frame(rows), toxicity.fit(frame(rows), labels)).collect()
    assert np.mean([r.predicted == int(r.doc_id % 4 == 0) for r in scored if r.doc_id in set(held)]) >= 0.95
    none = toxicity.fit(frame([]), spark.createDataFrame([], "doc_id long, toxic int"))
    assert all(r.predicted == 0 for r in toxicity.score(docs, none).collect())
    assert toxicity.score(frame([]), model).collect() == []


def test_label_model_finds_accuracies_and_correlations():
    rng = np.random.default_rng(2)
    y = rng.random(4000) < 0.3
    votes = np.stack([np.where(y, rng.random(4000) < p, rng.random(4000) < q) for p, q in ((0.9, 0.02), (0.6, 0.1), (0.5, 0.5), (0.3, 0.01))] * 1, axis=1)
    votes = np.column_stack([votes, votes[:, 1]])
    m = toxicity.LabelModel(votes, y.astype(int))
    assert m.on[:4] == pytest.approx([0.9, 0.6, 0.5, 0.3], abs=0.06) and m.off[:4] == pytest.approx([0.02, 0.1, 0.5, 0.01], abs=0.06)
    assert m.correlation[1, 4] > 0.8 and m.correlation[0, 2] < 0.1
    assert ((m.posterior > 0.5) == y).mean() > 0.97


def test_cumulative_link_recovers_grades():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((4000, 6)).astype(np.float32)
    z = x @ np.array([1.5, -1, 0.5, 0, 0, 2])
    theta = np.array([-1.5, 0.0, 2.0])
    y = (rng.random(4000)[:, None] > sigmoid(theta[None, :] - z[:, None])).sum(axis=1)
    w, t = cumulative_link(x, y, 4, 0.0)
    assert w == pytest.approx([1.5, -1, 0.5, 0, 0, 2], abs=0.25) and t == pytest.approx(theta, abs=0.25)


def test_fits_reach_their_minimum():
    rng = np.random.default_rng(8)
    x = rng.standard_normal((500, 30)).astype(np.float32)
    y = (x[:, 0] + 0.3 * rng.standard_normal(500) > 0).astype(np.float32)
    p = logistic(x, y, 1e-3)
    error = sigmoid(x @ p[:-1] + p[-1]) - y
    assert np.abs(x.T @ error / 500 + 1e-3 * p[:-1]).max() < 1e-4 and abs(error.mean()) < 1e-4
    assert minimise(lambda z: ((z - 3) @ (z - 3) * 50, 100 * (z - 3)), np.zeros(4)) == pytest.approx([3] * 4)
    with pytest.raises(RuntimeError, match="converged"):
        minimise(lambda z: ((z - 3) @ (z - 3) * 50, 100 * (z - 3)), np.zeros(4), most=0)


def test_quality(spark, frame, odd_docs):
    rows, ratings = labelled(spark, 500, lambda i: "$$$ ### " * 30, "quality")
    ratings = ratings.withColumn("quality", 1 - quality.F.col("quality"))
    docs = frame(rows)
    model = quality.fit(docs, ratings)
    got = {r.doc_id: r for r in quality.score(docs, model).collect()}
    held = [i for i in got if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].selected == (i % 4 != 0) for i in held)
    assert sorted(r.doc_id for r in quality.keep_good(docs, ratings).collect()) == [i for i in range(500) if i % 4]
    graded = spark.createDataFrame([(i, (i % 4 != 0) * (1 + i % 2)) for i in range(500)], "doc_id long, quality int")
    three = quality.fit(docs, graded)
    assert len(three.thresholds) == 2 and three.thresholds[0] < three.thresholds[1]
    odd = quality.score(frame(odd_docs), three, cut=2).collect()
    assert len(odd) == len(odd_docs) and all(0 <= r.tail_prob <= 1 and 0 <= r.expected_grade <= 2 for r in odd)
    none = quality.fit(frame([]), spark.createDataFrame([], "doc_id long, quality int"))
    assert all(r.selected for r in quality.score(docs, none).collect()) and quality.score(frame([]), model).collect() == []


class Tied(dict):
    """A tree that holds every style and tells nothing of it."""

    def __contains__(self, style):
        return True

    def get(self, style, default=None):
        return (0.0, 0.0)


def test_html_pages():
    same = lambda page, text: page_text(page, Tied()) == text
    assert same("", "") and same("plain  text", "plain text") and same("a < b &lt;i&gt; &amp;amp;", "a < b <i> &amp;")
    assert same("<title>t</title><nav>n</nav><article><h1>T</h1><p>a<b>b</b> c<p>d<br>e</article><footer>f</footer>", "T\n\nab c\n\nd e")
    assert same("<body><header>H</header><div class='cookie-notice'>c</div><div id=main><p>One<li>x<li>y</div><section class=comments><p>zz</section><form>a<input></form>tail", "One\n\nx\n\ny\n\ntail")
    assert same("<article><p>a<aside>no</aside>b</p><script>if (a<b) '</p>'</script><!-- <p>c</p> --><table><tr><td>1<td>2</table></article><p>out", "a\n\nb\n\n1\n\n2\n\nout")
    assert same("<article><p>cut off in a <a href='x", "cut off in a") and same("<p title='a>b'>x</p>", "x")
    assert same("<article class=teaser>t</article><div class=story><p>s</div><nav>n</nav>", "t\n\ns")
    assert same("<article><p>so <math><mi>x</mi></math> is<p class=notice>n<div class=share-price>5</div><div class=ad>x</div></article>", "so x is\n\nn\n\n5\n\nx")  # no word list cuts an article
    assert same("<div class=entry-header><h1>T</h1></div><section id=discussion>d</section><div class=form-factor>f</div><div class='main-nav'>n</div>", "T\n\nd\n\nf")
    assert page_text("<nav>n</nav><article>a</article><footer>f</footer>", {}) == "n\n\na\n\nf"  # a tree that holds nothing removes nothing
    assert host_of("HTTPS://u@Ex.Com:80/x") == "ex.com" and host_of(None) == host_of("nonsense") == ""


def test_html_rich_and_fresh_branches_overrule_their_names():
    page = "<div class=widget><p>new</p></div><nav>n</nav>"
    nodes, _ = blocks(page)
    known = {n.style: (0.02, 0.9 if n.tag == "div" else 0.0) for n in nodes}
    assert page_text(page, known) == "new"
    assert page_text(page, {k: (0.9, p) for k, (_, p) in known.items()}) == ""
    inside = "<article><p>own</p><p class=sign>The usual end</p></article>"
    known = {n.style: (0.9 if k == 3 else 0.0, 0.1) for k, n in enumerate(blocks(inside)[0])}
    assert page_text(inside, known) == "own"  # within an article, too


def test_html_real_pages_come_through_the_tree(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    article = {r.page_id: page_text(re.search("<article>.*?</article>", r.html, re.S)[0], {}) for r in rows.collect()}
    got = {r.page_id: r.text for r in extract_text(rows).collect()}
    assert got == article
    without = {r.page_id: page_text(r.html, {}) for r in rows.collect()}
    assert all(without[i] != got[i] for i in got)


@pytest.mark.parametrize("small", [200_000, 0])
def test_html_site_style_tree(spark, monkeypatch, small):
    monkeypatch.setattr(html_extract, "SMALL", small)
    page = lambda i: f"<body><div class=top>Welcome to our site<div>Call now</div></div><div class=text><p>{prose(i, 20)}</p>{'<p>more</p>' * (i % 3)}</div><div class=bottom>All the same</div></body>"
    rows = [(i, "http://a.example/x", page(i)) for i in range(30)] + [(100, "http://b.example/", page(5)), (101, None, None), (102, "", ""), (100, "http://b.example/", page(5)), (None, "x", "<p>y")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", quality.F.lit("clash")).withColumn("host", quality.F.lit(1)).repartition(4)
    got = defaultdict(list)
    for r in extract_text(df).collect():
        assert r.n_chars == len(r.text)
        got[r.page_id].append(r.text)
    assert len(rows) == sum(map(len, got.values()))
    for i in range(30):
        assert got[i] == ["\n\n".join([prose(i, 20), *["more"] * (i % 3)])]
    assert got[100][0] == got[100][1] and got[100][0].startswith("Welcome to our site\n\nCall now")  # two equal pages recur as a whole: their main text stays, and all that stands beside it
    assert got[101] == [""] and got[102] == [""] and got[None] == ["y"]
    assert extract_text(df.limit(0)).collect() == []
    tree = entropies(feature_counts(df), "host", "style", "near").collect()
    assert all(0 <= x <= 1.0001 for r in tree for x in (r.repetition, r.presentation))


def test_kernel_hits_are_whole_text():
    chosen = np.sort(toxicity.lexicon_hashes("zebra yak"))
    rows, at, _ = toxicity.hits(pa.array([("x " * 200000 + "zebra").encode(), b"ZEBRA, yak", None], pa.binary()), chosen)
    assert Counter(rows.tolist()) == {0: 1, 1: 2}
