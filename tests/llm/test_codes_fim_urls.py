"""Vector codes, fill-in-the-middle and URL filter against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from brute import sha
from conftest import SF_DIR
from pyspark.sql import functions as F

from ledgerlink.llm import fill_middle, url_filter, vector_codes
from ledgerlink.llm.queries import QUERIES

# --- vector codes -----------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, v string, codes int, error string, low string"


def plain_codes(rows, parts=4, entries=256, rounds=4):
    """{position: (vec_id, code, error, label_error)}, codebook digest; every distance in every round."""
    kept = []
    for i, vector, label in rows:
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((i, [math.floor(1024 * float(np.float32(x))) for x in vector], label))
    if not kept:
        return [], None
    depth = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * depth : (p + 1) * depth]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(v, p) for _, v, _ in first] for p in range(parts)]

    def nearest(part, book):
        d = [sum((a - b) ** 2 for a, b in zip(part, entry)) for entry in book]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        for p in range(parts):
            members = defaultdict(list)
            for _, v, _ in kept:
                members[nearest(cut(v, p), books[p])[0]].append(cut(v, p))
            books[p] = [
                [sum(c) // len(members[e]) for c in zip(*members[e])] if e in members else entry
                for e, entry in enumerate(books[p])
            ]
    out, by_label = [], Counter()
    for i, v, label in kept:
        found = [nearest(cut(v, p), books[p]) for p in range(parts)]
        error = sum(d for _, d in found)
        by_label[label] += error
        out.append((i, "".join(f"{e:02x}" for e, _ in found), error, label))
    digest = sha(",".join(str(x) for book in books for entry in book for x in entry))
    return [(i, c, e, by_label[label]) for i, c, e, label in out], digest


def awkward_vectors(n, spread, dim=8):
    rng = random.Random(n)
    rows = [(i, [rng.choice([-1, 0, 1]) * spread + rng.gauss(0, spread / 9) for _ in range(dim)], i % 3) for i in range(n)]
    rows += [(n + i, list(rows[i][1]), None) for i in range(5)]  # ties: equal vectors
    rows += [(1, list(rows[1][1]), 1), (None, list(rows[2][1]), None), (None, [0.5] * dim, 2)]
    rows += [(9000, None, 1), (9001, [1.0] * (dim - 1) + [None], 1), (9002, [float("nan")] * dim, 2)]
    rows += [(9003, [float("-inf")] * dim, 2), (9004, [-0.0] * dim, 2), (9005, [1e-30] * dim, None)]
    return rows


@pytest.mark.parametrize("n, spread", [(40, 1.0), (420, 0.3), (330, 60_000.0)])
def test_vector_codes(spark, n, spread):
    rows = awkward_vectors(n, spread)
    frame = spark.createDataFrame([(*r, "x", 1, "e", "l") for r in rows], VECTORS).repartition(5)
    got = [tuple(r) for r in vector_codes.code_digests(frame).collect()]
    want, digest = plain_codes(rows)
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted([r[:4] for r in got], key=key) == sorted(want, key=key)
    assert {r[4] for r in got} == {digest}


def test_vector_codes_without_rows_and_of_other_lengths(spark):
    assert vector_codes.code_digests(spark.createDataFrame([], VECTORS)).collect() == []
    none = [(1, None, 1, None, None, None, None), (2, [None], 1, None, None, None, None)]
    assert vector_codes.code_digests(spark.createDataFrame(none, VECTORS)).collect() == []
    hollow = spark.createDataFrame([(1, [], 1, None, None, None, None)], VECTORS)
    assert [r[1:3] for r in vector_codes.code_digests(hollow).collect()] == [("00000000", 0)]
    for vectors in ([[1.0] * 8, [1.0] * 4], [[1.0] * 6]):
        ragged = spark.createDataFrame([(i, v, 1, None, None, None, None) for i, v in enumerate(vectors)], VECTORS)
        with pytest.raises(Exception, match="same length"):
            vector_codes.code_digests(ragged).collect()


def test_bounds_spare_scans_and_change_nothing():
    """Net displacement beats summed moves, and codes equal those of full scans in every round."""
    rng = np.random.default_rng(5)
    centres = rng.integers(-900, 900, (256, 16))
    x = centres[rng.integers(0, 256, 3000)] + rng.integers(-60, 60, (3000, 16))
    history = [x[:256].copy()]
    own = np.zeros(len(x), np.int64)
    low, stamp = np.zeros((len(x), 8), np.float32), np.zeros((len(x), 8), np.uint8)
    scanned = []
    for _ in range(6):
        assigner = vector_codes.Assigner(np.array(history))
        own, best, low, stamp = assigner.assign(x, own, low, stamp)
        scanned.append(assigner.scanned)
        full = vector_codes.squared(x, history[-1])
        assert (own == full.argmin(axis=1)).all() and (best == full.min(axis=1)).all()
        others = np.sqrt(full)
        others[np.arange(len(x)), own] = np.inf
        now = low - assigner.net[stamp, np.arange(8)[None, :]]
        assert (now <= others.reshape(len(x), 8, 32).min(axis=2) + 1e-6).all()
        new = history[-1].copy()
        for e in np.unique(own):
            new[e] = x[own == e].sum(axis=0) // (own == e).sum()
        history.append(new)
    assert scanned[0] == x.shape[0] * 256 and scanned[-1] < scanned[0] / 4
    moves = [np.linalg.norm(b - a, axis=1) for a, b in zip(history[:-1], history[1:])]
    net = np.linalg.norm(history[-1] - history[0], axis=1)
    assert (net <= sum(moves) + 1e-6).all() and net.sum() < sum(moves).sum()


def test_codes_stand_for_vectors(spark):
    rows = spark.createDataFrame([(i, [i / 4.0, 1.0, 2.0, 3.0], 0) for i in range(8)], "vec_id long, embedding array<float>, label int")
    made = vector_codes.compress_vectors(vector_codes.scaled(rows), entries=8)
    got = {r[0]: r[1] for r in made.rows.select("vec_id", made.approximated()).collect()}
    assert got == {i: [i / 4.0, 1.0, 2.0, 3.0] for i in range(8)}


# --- fill-in-the-middle -----------------------------------------------------

DOCS = "doc_id long, text string, bytes string, cut string, form int, n long, output string"


def plain_fim(key, text, unit="line"):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text) if unit == "line" else list(text)
    h = hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    if h4 % 100 < 50:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def fim_texts():
    rng = random.Random(4)
    texts = [None, "", "\n", "\n\n\n", "a", "a\n", "\na", "a\r\nb\u2028c\x0bd", "日本語\nテキスト\n🙂🙂", "x <P> y\nz", "<S>", "<M", "<P\n>"]
    texts += ["<\n<\n>", "S>\n<", "\x00\n\x00", "\n" * 1000, "é" * 70_000 + "\n" + "z" * 9, "line\n" * 60_000]
    for _ in range(150):
        texts.append("".join(rng.choice("ab\n\né日🙂<>PSM ") for _ in range(rng.randrange(0, 90))))
    return texts


@pytest.mark.parametrize("unit", ["line", "char"])
def test_fill_in_middle(spark, unit):
    texts = fim_texts()
    rows = [(i, t, "b", "c", 1, 2, "o") for i, t in enumerate(texts)] + [(None, "a\nb\nc", *[None] * 5)] * 2
    frame = spark.createDataFrame(rows, DOCS).repartition(3)
    made = fill_middle.fill_in_middle(frame, unit=unit)
    got = made.withColumn("back", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    assert len(got) == len(rows)
    for r in got:
        text = "a\nb\nc" if r.doc_id is None else texts[r.doc_id]
        assert tuple(r)[1:] == (*plain_fim(r.doc_id, text, unit), text or ""), (r.doc_id, unit)


def test_fill_in_middle_shares_sentinels_and_empty(spark):
    rows = [(i, f"a{i}\nb\nc\n", None, None, None, None, None) for i in range(3000)]
    frame = spark.createDataFrame(rows, DOCS)
    forms = Counter(r.form for r in fill_middle.fill_in_middle(frame, share=60, spm_share=25).collect())
    assert abs(forms["plain"] / 3000 - 0.4) < 0.04 and abs(forms["spm"] / 1800 - 0.25) < 0.05
    own = fill_middle.fill_in_middle(frame, sentinels=("[a", "]b", "|c")).where("form = 'psm'").first()
    assert own.output.startswith("[a")
    for bad in (("<P>", "<P>", "<M>"), ("", "<S>", "<M>"), ("<P>", ">S<", "<M>"), ("aba", "x", "y")):
        with pytest.raises(ValueError):
            fill_middle.fill_in_middle(frame, sentinels=bad)
    with pytest.raises(ValueError):
        fill_middle.fill_in_middle(frame, unit="word")
    assert fill_middle.fim_digests(spark.createDataFrame([], DOCS)).collect() == []


def test_fill_in_middle_on_table(spark):
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()}
    for r in QUERIES["op12_fill_middle"](spark, SF_DIR).collect():
        n, form, p, m, output = plain_fim(r.doc_id, texts[r.doc_id])
        assert tuple(r)[1:] == (n, form, p, m, sha(output), sha(texts[r.doc_id] or ""))


# --- URL filter -------------------------------------------------------------


def split_plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    return host, re.split("[?#]", rest[end:], maxsplit=1)[0]


def rule_plain(host, path, rules):
    fit = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    return min(fit, key=lambda r: (-len(r[1] + r[2]), r), default=None)


def shape_plain(s, always=False):
    if re.fullmatch(r"<[a-z]+>(\.[a-z*]+)?", s):
        return s
    ending = re.search(r"\.([A-Za-z][A-Za-z0-9]{0,4})$", s)
    stem = s[: ending.start()] if ending else s
    suffix = "" if not ending else "." + ending[1].lower() if ending[1].lower() in url_filter._SUFFIXES else ".*"
    for name, pattern, sure in url_filter.SHAPES:
        if (sure or not always) and re.fullmatch(pattern, stem):
            return name + suffix
    return s


def tree_plain(pages, rules):
    """[(host, path, rule, verdict, template)] by growing each host's tree in memory."""
    rows = []
    for url in pages:
        host, path = split_plain(url)
        rule = rule_plain(host, path, rules)
        parts = [shape_plain(s.replace("<", "<<").replace("{", "{{"), True) for s in path.split("/") if s]
        parts = parts[:6] + (["<rest>"] if len(parts) > 6 else [])
        rows.append([host, path, rule, parts, "", None])
    known = [r for r in rows if r[2]]
    base = (sum(r[2][0] == "block" for r in known) + 1) / (len(known) + 2)

    def rate(part, above):
        labelled = [r for r in part if r[2]]
        return (sum(r[2][0] == "block" for r in labelled) + 10 * above) / (len(labelled) + 10)

    def grow(part, level, node, here):
        for r in part:
            r[4], r[5] = node, here
        part = [r for r in part if len(r[3]) > level]
        counts = Counter(r[3][level] for r in part)
        tokens = defaultdict(list)
        for r in part:
            s = r[3][level]
            kept = counts[s] >= 4 and counts[s] >= 0.02 * len(part)
            tokens[s if kept else shape_plain(s)].append(r)
        branches = []
        for token, members in sorted(tokens.items(), key=lambda t: (-len(t[1]), t[0])):
            follow = Counter(shape_plain(r[3][level + 1]) if len(r[3]) > level + 1 else "<end>" for r in members)
            marks = [r[2][0] == "block" for r in members if r[2]]
            for b in branches:
                room = lambda n, m: math.sqrt(0.5 * math.log(40)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))
                n, m = len(b["rows"]), len(members)
                apart = any(abs(b["follow"][k] / n - follow[k] / m) > room(n, m) for k in {*b["follow"], *follow})
                if bool(b["marks"]) != bool(marks) or apart:
                    continue
                if marks and abs(sum(b["marks"]) / len(b["marks"]) - sum(marks) / len(marks)) > room(len(b["marks"]), len(marks)):
                    continue
                break
            else:
                b = {"rows": [], "follow": Counter(), "marks": [], "names": []}
                branches.append(b)
            b["rows"] += members
            b["follow"] += follow
            b["marks"] += marks
            b["names"].append(token)
        for b in branches:
            name = b["names"][0] if len(b["names"]) == 1 else "{" + "|".join(sorted(b["names"])) + "}"
            grow(b["rows"], level + 1, f"{node}/{name}", rate(b["rows"], here))

    for host in {r[0] for r in rows}:
        part = [r for r in rows if r[0] == host]
        grow(part, 0, "", rate(part, base))
    return [
        (h, p, r[1] + r[2] if r else None, r[0] if r else "block" if 1 - q < 0.5 else "allow", t, round(1 - q, 9))
        for h, p, r, _, t, q in rows
    ]


def awkward_urls():
    rng = random.Random(8)
    urls = [None, "", "no scheme/x", "http://", "://", "http://?q", "HTTP://A.ORG", "http://a.org/", "http://A.Example.ORG/es/1?x=/en/"]
    urls += ["http://org/x", "http://xorg/x", "http://example.org/es", "x://y://z/q", "http://h/a//b/", "http://h/\n/ü/日本/<num>/{a|b}"]
    urls += ["http://É.com/fr/1", "http://u@example.org:80/es/2", "http://example.org/en/1x", "http://h/" + "d/" * 40, "http://h/" + "x" * 20_000]
    for _ in range(900):
        host = rng.choice(["a.com", "a.com", "a.com", "b.com", "s.example.org", "c.net"])
        kind = rng.choice(["fr", "de", "en", "es", "tag", "v1"])
        leaf = rng.choice([
            f"{rng.randrange(9999)}", f"{rng.randrange(9999)}.html", f"some-long-title-{rng.randrange(999)}", "about", "2024-01-02",
            f"{rng.randrange(16**9):09x}", f"w{rng.randrange(500)}.XYZ", f"{rng.randrange(99)}/comments/{rng.randrange(9)}",
        ])
        urls.append(f"https://{host}/{kind}/{leaf}" + rng.choice(["", "/", "?a=1", "#x"]))
    return urls + ["https://bulk.com/de/7"] * 60


PAGES = "page_id long, url string, html string, host string, path string, n long, segments string, label string"


def judged(spark, urls):
    rows = [(i, u, None, "h", "p", 1, "s", "l") for i, u in enumerate(urls)]
    made = url_filter.judge_urls(spark.createDataFrame(rows, PAGES).repartition(4)).collect()
    assert sorted(r.page_id for r in made) == list(range(len(urls)))
    return [(r.host, r.path, r.rule, r.verdict, r.template, round(r.purity, 9)) for r in sorted(made)]


def test_url_filter(spark):
    urls = awkward_urls()
    got = judged(spark, urls)
    want = tree_plain(urls, url_filter.RULES)
    assert got == want
    assert {r[3] for r in got if r[2] is None} == {"allow", "block"}
    assert any("{" in r[4] for r in got) and any("<num>" in r[4] for r in got)


def test_url_filter_on_table(spark):
    urls = [r[1] for r in sorted(spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "url").collect())]
    got = [tuple(r) for r in sorted(QUERIES["op13_url_filter"](spark, SF_DIR).collect())]
    assert [(*r[1:6], round(r[6], 9)) for r in got] == tree_plain(urls, url_filter.RULES)


def test_url_filter_labels_nulls_and_empty(spark):
    rows = [(None, f"http://spam.net/offers/{i}", "x", None, None, None, None, None) for i in range(30)]
    rows += [(None, f"http://spam.net/help/{i}", "", None, None, None, None, None) for i in range(30)]
    frame = spark.createDataFrame(rows, PAGES)
    learnt = url_filter.judge_urls(frame, [], F.when(F.col("url").rlike("[02468]$"), F.col("html") == "x"))
    found = Counter((r.template, r.verdict) for r in learnt.collect())
    assert found == {("/offers/<num>", "block"): 30, ("/help/<num>", "allow"): 30}
    assert {r.verdict for r in url_filter.judge_urls(frame, []).collect()} == {"allow"}
    assert url_filter.judge_urls(spark.createDataFrame([], PAGES)).collect() == []
