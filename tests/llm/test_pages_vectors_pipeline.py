"""Page extraction, embeddings and the pipeline."""

import html
import random
import re

import brute
import numpy as np
import pandas as pd
import pytest
from conftest import SF_DIR

import corpus_pipeline
from ledgerlink.llm import embedding_dedup, html_extract
from ledgerlink.llm.common import saved
from ledgerlink.llm.queries import QUERIES


@pytest.fixture(scope="module")
def model():
    return html_extract.train()


def test_pages_of_the_table(spark, model):
    pages = pd.read_parquet(f"{SF_DIR.replace('sf0.001', 'sf0.01')}/pages.parquet")

    def article(page):
        inner = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
        return " ".join(html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"</?(?:p|h1)>|<br>", " ", inner))).split())

    got = {r["page_id"]: r for r in QUERIES["op3_html_extract"](spark, SF_DIR.replace("sf0.001", "sf0.01")).collect()}
    assert len(got) == len(pages)
    for page_id, page in zip(pages.page_id, pages.html):
        assert got[page_id]["text"] == article(page) and got[page_id]["n_chars"] == len(article(page))


def test_drawn_pages_not_seen_in_training(model):
    rng, exact = random.Random(77), 0
    for _ in range(150):
        page = html_extract.training_page(rng)
        tree = html_extract.parse(page)
        want = " ".join(t.replace(html_extract._MARK, "") for t in tree.texts if html_extract._MARK in t)
        exact += html_extract.extract([page.replace(html_extract._MARK, "")], model)[0] == want
    assert exact >= 140


def test_decoding_never_keeps_a_child_of_a_dropped_node():
    tree = html_extract.parse("<div><p>one two</p></div><div><p>three</p></div>")
    scores = np.full(len(tree.tags), 1.0)
    scores[1] = -9  # the first div
    assert html_extract.decode(tree, scores) == ["three"]


def test_awkward_pages(spark, model):
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    odd = [None, "", "   ", "<", "<p", "</p></div>", "<!-- open", "<script>x", "plain text only.", deep, "<p>a&amp;b&nbsp;c &#x41;</p>" * 3, "<a href='>'>x</a>", "x" * 200_000]
    rows = [(i, None if i % 2 else "u", h, "t", 5) for i, h in enumerate(odd)] + [(None, None, None, None, None), (3, "u", "<p", "t", 5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long")
    got = html_extract.extract_pages(pages, model).collect()
    assert len(got) == len(rows)
    texts = {r["page_id"]: r["text"] for r in got}
    assert texts[None] == texts[1] == texts[2] == texts[7] == ""
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert html_extract.extract_pages(pages.limit(0), model).count() == 0


@pytest.mark.parametrize("odd", [
    '<svg class="i"/>', "<svg><title/><path d='z'/></svg>", "<svg/><svg><path d='z'></svg>", "<math/>", "<svg class='i'><path d='z'>",
    "<p hidden>gone", "<ul><li>one<li style='display:none'>gone<li>two</ul>", "<ul><li hidden><p>gone<li>two</ul>", "<ul><li><div hidden>gone</li><li>two</ul>",
    "<table><tr><td>one<td hidden>gone<tr><td>two</table>", "<table><tr><td>one<td hidden>gone</tr><tr><td>two</table>", "<table><tr hidden><td>gone<tr><td>two</table>",
    "<table><thead hidden><tr><th>gone<tbody><tr><td>two</table>", "<dl><dt hidden>gone<dd>two</dl>", "<p hidden>gone<hr>two",
    "<div><span hidden/>gone</div>", "<div><div hidden/>gone</div></div>", "<p><b>one <span hidden/>gone</b> two</p>", "<p>one <span hidden><span>gone</span> gone</span> two</p>",
    "<script>'\u0130\u0130\u0130\u0130\u0130\u0130\u0130\u0130'</script>", "<style>\u0130</STYLE><style>gone</style>", "<script>'</scripts>gone'</script>",
    "<select><option>gone<option>gone</select>", "<datalist><option>gone<option>gone</datalist>",
])
def test_hidden_elements_end_where_html_ends_them(odd):
    for before, after in (("<body><article>", "</article>"), ("<head><title>gone</title><article>", "</article>"), ("<div>", "</div>")):
        texts = [t for t in html_extract.parse(f"<html>{before}{odd}<p>the article</p>{after}<p>the end</p></html>").texts if t]
        shown = [w for w in ("one", "two") if w in re.sub("<[^>]*>", " ", odd).split()]
        assert " ".join(texts).split() == [*shown, "the", "article", "the", "end"]


@pytest.mark.parametrize("odd", [
    "<p title=it's>", "<a href=/it's>", '<div class="a"">', "<!-->", "<!--->", "<!-- x --!>", "<!-- a -- > b -->", "<p x= \"a>b\" y>",
    "<p a=\"1\"b='2'/c>", "<p =x>", "<p x=>", "<p x==y>", '<p "q>', "<i a=b/>", "<p a = >", '<p a=`x"y`>', '<p a\n=\n"b>c">', "<p a=b'c d='e>f'>",
])
def test_tags_end_where_html_ends_them(odd):
    tree = html_extract.parse(f"<html><body>{odd}the article</p><p>the end \"it's\" > here</p></html>")
    assert [t for t in tree.texts if t] == ["the article", "the end \"it's\" > here"]


@pytest.mark.parametrize("old, new", [
    (' class="ad"', ""), ('class="ad"', 'class="zq7"'), ("article>", "div>"), ("article>", "main>"),
])
def test_pages_of_the_table_with_other_names(model, old, new):
    pages = pd.read_parquet(f"{SF_DIR.replace('sf0.001', 'sf0.01')}/pages.parquet").html
    assert html_extract.extract([p.replace(old, new) for p in pages], model) == html_extract.extract(list(pages), model)


def plain_links(rows):
    ids, pairs, count = [r[0] for r in rows], [], {r[0]: 0 for r in rows}
    good = [r for r in rows if r[1] is not None and r[2] is not None and r[1] and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])]
    for k, (a, u, label) in enumerate(good):
        for b, v, other in good[k + 1 :]:
            if label == other and len(u) == len(v):
                u64, v64 = np.array(u, float), np.array(v, float)
                if u64 @ v64 / np.sqrt((u64 @ u64) * (v64 @ v64)) >= 0.98:
                    pairs.append((a, b))
                    count[a] += 1
                    count[b] += 1
    component = brute.groups(ids, pairs)
    return {i: (count[i], component[i], component[i] == i) for i in ids}


def test_vectors(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(6, 16))
    rows = []
    for i in range(260):
        v = centres[i % 6] + rng.normal(size=16) * (0.02 if i % 3 else 0.25)
        rows.append((i, np.float32(v).tolist(), int(i % 2)))
    rows += [(300, None, 1), (301, [0.0] * 16, 1), (302, [float("nan")] * 16, 1), (303, [None] * 16, 1), (304, rows[0][1], None), (305, [], 1), (306, [1.0, 2.0], 1), (307, [2.0, 4.0], 1), (308, [float("inf")] + [1.0] * 15, 1)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, packed string").repartition(4)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.near_vectors(frame).collect()}
    assert got == plain_links(rows)
    assert embedding_dedup.near_vectors(frame.limit(0)).count() == 0
    twice = embedding_dedup.near_vectors(frame.union(frame)).count()
    assert twice == len(rows)


def test_a_component_larger_than_a_cell(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "_CELL", 16)
    rng = np.random.default_rng(5)
    rows = [(i, np.float32(np.ones(8) + rng.normal(size=8) * 0.08).tolist(), 1) for i in range(120)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.near_vectors(frame).collect()}
    assert got == plain_links(rows)


def alike(seed, pairs, size, mean=0.7):
    """Twice as many unit vectors, of that mean cosine; each links with one other at a cosine of just over 0.98."""
    rng = np.random.default_rng(seed)
    unit = lambda v: v / np.linalg.norm(v, axis=-1, keepdims=True)
    first = unit(np.sqrt(mean) * np.eye(size)[0] + np.sqrt(1 - mean) * unit(rng.normal(size=(pairs, size))))
    aside = rng.normal(size=first.shape)
    aside = unit(aside - (aside * first).sum(axis=1, keepdims=True) * first)
    return np.float32(np.stack([first, 0.981 * first + np.sqrt(1 - 0.981**2) * aside], axis=1).reshape(-1, size))


def link_matrix(queries, vectors):
    unit = [v.astype(float) / np.linalg.norm(v.astype(float), axis=1, keepdims=True) for v in (queries, vectors)]
    return unit[0] @ unit[1].T >= 0.98


def test_copies_of_vectors_do_not_fill_the_window(spark):
    vectors = alike(6, 600, 24)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "i long, embedding array<float>")
    rows = frame.crossJoin(spark.range(60).withColumnRenamed("id", "k")).selectExpr("i * 60 + k as vec_id", "embedding", "1 as label")
    got = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_vectors(rows).collect()}
    links = link_matrix(vectors, vectors).sum(axis=1) * 60 - 1
    assert len(got) == 60 * len(vectors) and all(got[i * 60 + k] == n for i, n in enumerate(links) for k in (0, 59))


@pytest.mark.parametrize(("mean", "pairs"), [(0.7, 15_000), (0.95, 5_000)])
def test_recall_in_a_hot_label_of_like_vectors(spark, mean, pairs):
    vectors = alike(7, pairs, 48, mean)
    rows = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, label int").repartition(8)
    got = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_vectors(rows).collect()}
    queries = range(0, len(vectors), 20)
    links = link_matrix(vectors[::20], vectors).sum(axis=1) - 1
    recall = sum(got[i] for i in queries) / links.sum()
    print("recall", recall, "of", links.sum())
    assert links.sum() >= len(queries) and recall > 0.995


def test_labels_too_alike_for_passes_are_compared_wholly(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(i, np.float32(np.ones(6) * 3 + rng.normal(size=6) * (0.45 if i < 900 else 0.05)).tolist(), int(i < 900)) for i in range(960)]
    assert embedding_dedup.passes_for(900, 0.98, window=2) == 0
    monkeypatch.setattr(embedding_dedup, "_CELL", 128)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    seen = []
    whole = embedding_dedup._whole_links
    monkeypatch.setattr(embedding_dedup, "_whole_links", lambda vectors, cosine: seen.append(vectors.count()) or whole(vectors, cosine))
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.near_vectors(frame, passes=1, window=2).collect()}
    assert got == plain_links(rows) and seen and seen[0] >= 900


def test_short_vectors_stay_within_their_slack():
    rng = np.random.default_rng(9)
    for size in (1, 2, 16, 300):
        v = rng.normal(size=(400, size)) * 10.0 ** rng.integers(-3, 3, size=(400, 1))
        unit = v / np.linalg.norm(v, axis=1, keepdims=True)
        short = np.rint(unit * embedding_dedup._SCALE) / embedding_dedup._SCALE
        assert np.abs(unit @ unit.T - short @ short.T).max() <= embedding_dedup.slack_of(size)


def test_a_forest_holds_what_all_links_hold():
    rng = np.random.default_rng(10)
    unit = rng.normal(size=(300, 3))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    for cosine in (0.9, 0.98, 0.999):
        left, right = embedding_dedup.forest(unit, cosine)
        every = list(zip(*np.nonzero(np.triu(unit @ unit.T >= cosine, 1)), strict=True))
        assert brute.groups(range(300), list(zip(left, right, strict=True))) == brute.groups(range(300), every)
        assert len(set(right)) == len(right) and all(unit[a] @ unit[b] >= cosine for a, b in zip(left, right, strict=True))


def test_passes_grow_with_the_label():
    passes = [embedding_dedup.passes_for(n, 0.5) for n in (2, 49, 1000, 10**6, 10**8)]
    assert passes[:2] == [1, 1] and 12 == passes[2] < passes[3] < passes[4]


def test_pipeline_stages(spark):
    sf_dir = SF_DIR
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(saved(stage(spark, seen[-1], sf_dir), name.replace(" ", "-")))
    assert all(d.columns == columns for d in seen[:-1])
    good, single, cut, clean = ({r["doc_id"]: r["text"] for r in d.collect()} for d in seen[1:5])
    assert set(good) <= {r["doc_id"] for r in docs.collect()} and len(good) > 100
    near = brute.near_groups(good)
    assert set(single) == {i for i, v in near.items() if v[2]}
    whole = {}
    removed = {i: v[:2] for i, v in brute.repeated_bytes(single, kept_texts=whole).items()}
    assert cut == {i: t for i, t in whole.items() if removed[i][0] == 0 or t}
    assert any(0 < r < n for n, r in removed.values())
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert set(clean) == {i for i, v in brute.contamination(cut, items).items() if not v[4]}
    final = {r["doc_id"] for r in seen[5].collect()}
    assert final == set(clean)
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, sf_dir).collect()} == final


ODD = ["doc_id long", "text string", "lang string", "kept string", "row int", "key string", "_was int", "_kept int", "n long", "runs string", "score double", "component string"]


def odd_documents(spark, sf_dir):
    """Real and awkward rows, repeated rows and ids, and columns named like inner ones; no n_chars."""
    real = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").limit(60).collect()
    passage = " ".join(f"shared{k} passage{k % 7}" for k in range(40))
    rows = [(r["doc_id"], r["text"]) for r in real] + [(r["doc_id"], r["text"]) for r in real[:5]]
    rows += [(9001, None), (9001, None), (9002, ""), (9003, "zzz one text of this id"), (9003, "aaa another text"), (9003, "aaa another text")]
    rows += [(9004, passage + " its own end follows here"), (9005, "another start " + passage), (9006, passage)]
    rows += [(None, passage), (None, passage), (None, None), (9007, "日本語 \U0001f642\n" * 9)]
    return spark.createDataFrame([(i, t, "en", "k", 1, "y", 2, 3, 4, "r", 0.5, "c") for i, t in rows], ", ".join(ODD))


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_a_stage_on_odd_tables(spark, name, stage):
    docs = odd_documents(spark, SF_DIR)
    out = stage(spark, docs, SF_DIR)
    rows = out.collect()
    ids = [r["doc_id"] for r in rows]
    named = {i for i in (r[0] for r in docs.select("doc_id").collect()) if i is not None}
    assert {i for i in ids if i is not None} <= named
    assert stage(spark, docs.limit(0), SF_DIR).count() == 0
    if name == "byte-level bpe":
        return
    assert out.columns == docs.columns
    assert all(tuple(r)[2:] == ("en", "k", 1, "y", 2, 3, 4, "r", 0.5, "c") for r in rows)
    texts = {}
    for i, t in sorted(((r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] is not None), key=lambda r: (r[0], r[1] is None, r[1])):
        texts.setdefault(i, t)
    if name in ("minhash near-dedup", "suffix-array dedup"):
        assert ids.count(None) == 3 and len(ids) - 3 == len(set(ids) - {None})
        got = {r["doc_id"]: r["text"] for r in rows if r["doc_id"] is not None}
        if name == "minhash near-dedup":
            assert got == {i: texts[i] for i, v in brute.near_groups(texts).items() if v[2]}
        else:
            whole = {}
            brute.repeated_bytes(texts, kept_texts=whole)
            assert got == {i: t for i, t in whole.items() if t or not texts[i]}


def test_repeated_bytes_go_without_texts_meeting_texts(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = corpus_pipeline.without_repeated_bytes(spark, docs, SF_DIR)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Relation \[doc_id#\d+L?,text#", plan)) == 2  # to cut pieces from, to remove runs from


def test_the_whole_pipeline_on_odd_tables(spark, tmp_path):
    for table in ("labels", "benchmark"):
        (tmp_path / f"{table}.parquet").symlink_to(f"{SF_DIR}/{table}.parquet")
    odd_documents(spark, SF_DIR).write.parquet(str(tmp_path / "documents.parquet"))
    got = [r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert len([i for i in got if i is not None]) == len({i for i in got if i is not None})
