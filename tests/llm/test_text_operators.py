"""The text operators against plain brute-force versions, and on edge cases, on small tables."""

import hashlib
import html as html_module
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from clearspan.llm import batches, bpe, classifier, common, components, extraction, minhash, mixing, ordered_minhash, ppm, rules, sharding, urls, wrappers
from clearspan.llm.queries import URL_RULES, vocabulary_path

DOCS = "doc_id long, text string, lang string, source string, node long, bucket string, `__row` int"


def documents(spark, rows):
    """Rows (doc_id, text, source) with further columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "en", s, 7, "x", 1) for i, t, s in rows], DOCS)


def prose(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def edited(rng, text, changes):
    words = text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"z{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def copies():
    """Exact and near copies, chains of them, short and empty texts, ties and repeated rows."""
    rng = random.Random(3)
    rows = []
    for g in range(12):
        base = prose(rng, rng.choice([6, 30, 120]))
        rows.append(base)
        for _ in range(rng.randrange(8)):
            rows.append(edited(rng, rng.choice([base, rows[-1]]), rng.randrange(4)))
        rows += [base.upper()] * (g % 3)
    shared = prose(rng, 60)
    rows += [f"{prose(rng, 40)} {shared} {prose(rng, 40)}" for _ in range(6)]
    rows += ["", None, " \n\t ", "one two", "one  two", "ONE TWO", "two one", "a b c d", "é b c d e", "É b c d e", prose(rng, 4000)]
    ids = list(range(len(rows)))
    rng.shuffle(ids)
    return [(i, t, "s") for i, t in zip(ids, rows)]


def shingle_set(text):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def brute_groups(rows):
    sets = {i: shingle_set(t) for i, t, *_ in rows}
    group = {i: i for i in sets}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                group[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_near_duplicates_are_those_of_all_pairs(spark, copies):
    found = minhash.near_duplicates(documents(spark, copies)).collect()
    want = brute_groups(copies)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)
    assert len(found) == len(copies)


def test_links_that_only_the_second_round_finds(spark):
    """A chain of texts, each like the next one only: no centre is linked to all."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(220)]
    rows = [(i, " ".join(words[7 * i : 7 * i + 100]), "s") for i in range(15)]
    rows += [(100 + i, edited(rng, rows[7][1], 1), "s") for i in range(10)]
    found = minhash.near_duplicates(documents(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_groups(rows)


def test_dedup_keeps_one_row_of_each_group(spark, copies):
    rows = [*copies, copies[0], (None, copies[0][1], "s"), (None, "only without a number " * 9, "s"), (None, "only without a number " * 9, "t"), (None, None, "s")]
    docs = documents(spark, rows)
    kept = minhash.deduplicated(docs).collect()
    want = {c for _, c in brute_groups(copies).values()}
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted(want)
    assert sorted((r.text or "") for r in kept if r.doc_id is None) == ["", "only without a number " * 9]
    assert minhash.deduplicated(docs).columns == docs.columns
    groups = minhash.near_duplicates(docs).where("doc_id IS NULL").collect()
    named = {c for _, c in brute_groups(copies).values()}
    assert sum(r.component_id in named for r in groups) == 1 and sum(r.kept for r in groups) == 3


def test_unlike_texts_of_one_id_join_their_groups(spark):
    rng = random.Random(6)
    a, b, c = (prose(rng, 40) for _ in range(3))
    rows = [(3, a, "s"), (5, a, "s"), (5, b, "s"), (9, b, "s"), (9, c, "s"), (11, c + " z", "s"), (12, prose(rng, 40), "s"), (13, "", "s"), (13, "", "s")]
    found = minhash.near_duplicates(documents(spark, rows)).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(3, 3), (5, 3), (5, 3), (9, 3), (9, 3), (11, 3), (12, 12), (13, 13), (13, 13)]
    kept = minhash.deduplicated(documents(spark, rows)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted([(3, a), (5, b), (9, c), (12, rows[6][1]), (13, ""), (13, "")])


def test_near_duplicates_of_a_small_table_are_kept_in_few_parts(spark, copies, monkeypatch):
    keep, parts = common.kept_once, []

    def counted(df):
        kept = keep(df)
        parts.append(kept.rdd.getNumPartitions())
        return kept

    monkeypatch.setattr(common, "kept_once", counted)
    monkeypatch.setattr(minhash, "kept_once", counted)
    docs, names = documents(spark, copies), ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = {name: spark.conf.get(name) for name in names}
    expected = sorted(r["doc_id"] for r in minhash.deduplicated(docs).collect())
    parts.clear()
    try:
        for name, value in zip(names, ("40", "false"), strict=True):
            spark.conf.set(name, value)
        assert sorted(r["doc_id"] for r in minhash.deduplicated(docs).collect()) == expected
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    # How many links there are across components is not known before they are found.
    few = spark.sparkContext.defaultParallelism
    assert len(parts) > 6 and sum(n > few for n in parts) <= 1


def test_hashes_of_long_texts_leave_no_long_tables():
    data = np.frombuffer(random.Random(5).randbytes(3_000_001), dtype=np.uint8)
    starts = np.array([0, 2047, 2048, 2_999_990, 3_000_001])
    ends = np.array([5, 2050, 2048, 3_000_001, 3_000_001])
    tracemalloc.start()
    try:
        found = batches.span_hashes(data, starts, ends)
        assert tracemalloc.get_traced_memory()[0] < 1_000_000
    finally:
        tracemalloc.stop()
    sums = [sum(int(batches._byte_values()[b]) * pow(batches._MULTIPLIER, k, 2**64) for k, b in enumerate(data[s:e])) for s, e in zip(starts, ends, strict=True)]
    plain = np.array([(x + (int(e) - int(s)) * 0xD6E8FEB86659FD93) % 2**64 for x, s, e in zip(sums, starts, ends, strict=True)], dtype=np.uint64)
    assert (found == batches.mixed(plain)).all()


def test_near_duplicates_with_textual_ids_and_empty_tables(spark):
    rng = random.Random(7)
    a = prose(rng, 50)
    docs = spark.createDataFrame([("d1", a), ("d0", a + " x"), ("c", prose(rng, 50)), (None, a)], "doc_id string, text string")
    found = {(r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect()}
    assert found == {("d1", "d0", False), ("d0", "d0", True), ("c", "c", True), (None, "d0", False)}
    assert minhash.near_duplicates(docs.limit(0)).count() == 0 and minhash.deduplicated(docs.limit(0)).count() == 0


def test_salts_and_size_classes_lose_no_link(spark, monkeypatch):
    """Many texts that share buckets and are alike below the limit, with links between them that miss the centre."""
    monkeypatch.setattr(minhash, "BUCKET_ROWS", 3)
    rng = random.Random(8)
    base = prose(rng, 150, 10**6).split()
    rows = []
    for g in range(14):
        one = " ".join(w if rng.random() > 0.06 else f"g{g}x{k}" for k, w in enumerate(base))
        rows += [(10 * g + k, edited(rng, one, k), "s") for k in range(4)]
    found = minhash.near_duplicates(documents(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_groups(rows)


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3)]
    found = components.components(spark.createDataFrame(links, "x long, y long"))
    assert {r.node: r.component for r in found.collect()} == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}}


def test_estimates_of_min_max_signatures_are_unbiased():
    rng = random.Random(1)
    a = [f"w{i}" for i in range(400)]
    b = a[:300] + [f"x{i}" for i in range(100)]
    texts = [" ".join(a).encode(), " ".join(b).encode()]
    one, two = minhash.shingle_sets(texts)
    want = len(set(one.tolist()) & set(two.tolist())) / len(set(one.tolist()) | set(two.tolist()))
    values = minhash.signatures(*minhash.shingles(texts))
    assert rng and abs((values[0] == values[1]).mean() - want) < 0.15


def test_classifier_learns_the_tables_and_never_reads_the_labels_of_the_held_out(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(400):
        bad = i % 3 == 0
        text = prose(rng, rng.randrange(5, 80))
        rows.append((i, text.replace(" ", "### ") if bad else text, "s"))
        labels.append((i, 0 if bad else 1))
    labels += [(None, 1), (5, None), (10**6, 0)]
    docs, table = documents(spark, [*rows, (500, None, "s"), (None, "", "s"), rows[0]]), spark.createDataFrame(labels, "doc_id long, quality int")
    model = classifier.train(docs, table)
    found = classifier.score_documents(docs, model).collect()
    assert len(found) == 403 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
    for r in found:
        if r.doc_id is not None:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    held = [r for r in found if r.held_out and r.doc_id is not None and r.doc_id < 400]
    assert sum((r.predicted == 1) == (r.doc_id % 3 != 0) for r in held) >= 0.97 * len(held)
    flipped = spark.createDataFrame([(i, 1 - q if i is not None and q is not None and zlib.crc32(str(i).encode()) % 5 == 0 else q) for i, q in labels], "doc_id long, quality int")
    again = {r.doc_id: r.score for r in classifier.score_documents(docs, classifier.train(docs, flipped)).collect()}
    assert again == {r.doc_id: r.score for r in found}
    assert classifier.accepted(docs, model).columns == docs.columns


def test_classifier_without_labels(spark):
    docs, none = documents(spark, [(1, "a b", "s")]), spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in classifier.score_documents(docs, classifier.train(docs, none)).collect()] == [0.5]
    assert classifier.score_documents(docs.limit(0), classifier.train(docs.limit(0), none)).count() == 0


def brute_base(text):
    text = text or ""
    words = [w.decode() for w in text.encode().split()]
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def test_quality_rules_against_brute_force(spark):
    rng = random.Random(4)
    texts = ["", None, " ", "\n\n", "a", "a a", "a a a", "a a a a", "a b a b a", "é\u00a0é ü\u3000x\x85y", "same line\nsame line\n\nsame  line\nsame line"]
    texts += [prose(rng, n, v) for n in (3, 49, 50, 51, 300) for v in (2, 20, 1000)] + [prose(rng, 20000, 300)]
    texts += [prose(rng, 60, 5000).replace(" ", "$$$ ") for _ in range(4)]
    docs = documents(spark, [*((i, t, "s") for i, t in enumerate(texts)), (None, "x", "s"), (3, "\n\n", "s")])
    found = rules.judge_documents(docs).collect()
    assert len(found) == len(texts) + 2
    for r in found:
        want = brute_base("x" if r.doc_id is None else texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)
    assert not any(r.kept for r in found if r.doc_id is not None and "$$$" in (texts[r.doc_id] or ""))
    kept = {r.doc_id for r in found if r.kept}
    assert {r.doc_id for r in rules.accepted(docs).collect()} == kept
    assert rules.accepted(docs).columns == docs.columns
    assert rules.judge_documents(docs.limit(0)).count() == 0


def test_estimation_prefers_the_rules_that_agree():
    clear, noisy = (1, 1, 1, 0, 0, 1), (-1, -1, 0, 0, 0, 1)
    good, chances = rules.estimate([(clear, 900), (noisy, 100)])
    assert 0.85 < good < 0.95
    assert rules.posterior(clear, good, chances) > 0.99 and rules.posterior(noisy, good, chances) < 0.1


PAGE = (
    '<!DOCTYPE html><html><head><title>T {n}</title><style>p{{}}</style></head><body><header><h1>Site</h1></header>'
    '<nav><ul>{menu}</ul></nav><div class="cookie-notice">Accept</div><div class="ad">Buy {n}</div>'
    "<article><h1>Head {n} &amp; more</h1>{body}<div id=comments-{n}><p>First!</p></div></article>"
    '<aside>Side</aside><form><label>Mail</label><input></form><script>if (a < b) x("</p>")</script><footer>&copy; {n}</footer></body></html>'
)


def pages_of(rng, host, n):
    rows = []
    for i in range(n):
        body, lines = [], [f"Head {i} & more"]
        for _ in range(rng.randrange(5)):
            text = prose(rng, rng.randrange(1, 9))
            if rng.random() < 0.3:
                body.append(f"<p><b>{text}</b>\n  tail &eacute;&#33;<!-- c --> end<br>x</p>")
                lines.append(f"{text} tail é! end x")
            elif rng.random() < 0.3:
                body.append(f"<ul><li>{text}</li><li><a href='x>y'>{text}</a></li></ul>")
                lines += [text, text]
            else:
                body.append(f"<p>{text}" + ("</p>" if rng.random() < 0.8 else ""))
                lines.append(text)
        menu = "".join(f"<li><a href=/{k}>m{k}</a></li>" for k in range(rng.randrange(1, 5)))
        rows.append((f"http://{host}/{i}", PAGE.format(n=i, menu=menu, body="".join(body)), "\n".join(lines)))
    return rows


def test_extraction_finds_the_article_of_every_page(spark):
    rng = random.Random(6)
    rows = [r for host in ("a.example", "b.example") for r in pages_of(rng, host, 30)]
    odd = [
        ("http://c.example/1", None, ""), ("http://c.example/2", "", ""), (None, "<p>alone", "alone"), ("x", "no tags  at\nall", "no tags at all"),
        ("http://d.example", "<main><p>in main</p></main><p>out</p>", "in main"),
        ("http://d.example", "<article><p>un<b>closed <p>next &lt;", "unclosed\nnext <"), ("http://e.example", "<article></article>", ""),
        ("http://e.example", "<a <b <<< 1 < 2 <p class='x", "1 < 2"), ("http://e.example", "<p>" * 3000 + "deep", "deep"),
    ]
    table = [(i, u, h, "x", 1) for i, (u, h, _) in enumerate([*rows, *odd])]
    pages = spark.createDataFrame([*table, table[0]], "page_id long, url string, html string, host string, wrapper int")
    found = extraction.extract_pages(pages).collect()
    want = {i: t for i, (_, _, t) in enumerate([*rows, *odd])}
    assert len(found) == len(table) + 1
    wrong = [(r.page_id, r.text, want[r.page_id]) for r in found if r.text != want[r.page_id] and "<<<" not in (table[r.page_id][2] or "")]
    assert not wrong
    assert extraction.extract_pages(pages.limit(0)).count() == 0


def test_texts_that_all_pages_of_a_host_have_are_its_template(spark):
    """Under neutral names, in an article, and on pages without one; a line that varies is kept whole, and so are its like."""
    rows = []
    for i in range(8):
        body = "".join(f"<p>body {i} {k}</p>" for k in range(2 + i % 3))
        rows.append((i, "http://a.example/", f'<article><div class="x7">Our house</div>{body}<p>Read <b>{i}</b> on</p><p>All rights</p></article>'))
        rows.append((10 + i, "http://b.example/", f'<div class="q"><i>Same</i> here</div><div class="r">body {i}</div><div class="left-sidebar-wide">more {i}</div>'))
        rows.append((20 + i, "http://c.example/", "<div>alike</div>"))
    rows += [(30 + i, "http://d.example/", f"<div>alike</div><p>{i}") for i in range(2)]
    found = {r.page_id: r.text for r in extraction.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(8):
        assert found[i] == "\n".join([*(f"body {i} {k}" for k in range(2 + i % 3)), f"Read {i} on", "All rights"])
        assert found[10 + i] == f"body {i}\nmore {i}"
        assert found[20 + i] == "alike"  # one page, repeated
    assert found[30] == "alike\n0" and found[31] == "alike\n1"  # too few to tell


def test_wrappers_decide_the_main_article_and_keep_its_lines(spark):
    """Lines that every article has between its paragraphs stay; what readers add under neutral names goes, also where it is longer."""
    rows, want = [], {}
    for i in range(9):
        body = [f"paragraph {i} {k} with some more words in it" for k in range(3)]
        text = ["Introduction", *body, "To be continued."]
        remark = f"remark {i} " + "so much to say " * (40 if i == 4 else 1)
        html = "<body><article>" + "".join(f"<p>{t}</p>" for t in text) + f"</article><div class=u3><article class=x9><p>{remark}</p></article></div><div class=z2>Seen everywhere</div></body>"
        rows.append((i, "http://a.example/", html))
        want[i] = "\n".join(text)
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: (r.text, r.matched) for r in extraction.extracted(pages).collect()}
    assert found == {i: (t, True) for i, t in want.items()}
    # Without its wrapper the page with the long remark is read otherwise.
    assert wrappers.extract([], rows[4][2])[0] != want[4]


def test_folding_is_that_of_trying_every_group():
    rng = random.Random(13)

    def slow(nodes):
        changed = True
        while changed:
            changed = False
            for width in range(1, min(wrappers.LONGEST_GROUP, len(nodes) // 2) + 1):
                out, i = [], 0
                while i < len(nodes):
                    group, j = nodes[i : i + width], i + width
                    while nodes[j : j + width] == group and len(group) == width:
                        j += width
                    if j > i + width:
                        out.append(group[0] if width == 1 and isinstance(group[0], tuple) else ("+", tuple(group)))
                        i, changed = j, True
                    else:
                        out.append(nodes[i])
                        i += 1
                nodes = out
        return nodes

    for _ in range(300):
        stream = [rng.choice("abc") for _ in range(rng.randrange(40))]
        assert wrappers.fold(stream) == slow(stream)


def test_every_page_of_a_host_takes_part_in_its_wrappers(spark):
    """Templates and optional blocks that one page of many has, and more different streams than one task aligns."""
    rng = random.Random(12)
    rows = [(u, h) for u, h, _ in pages_of(rng, "a.example", 60)]
    rows += [("http://a.example/rare", "<body><table><tr><td>rare</td></tr></table><dl><dt>x<dd>y</dl></body>")]
    rows += [("http://a.example/o", rows[0][1].replace("<article>", "<section><h6>only here</h6></section><article>"))]
    rows += [("http://b.example/", "<div>" + "".join(f"<{rng.choice(['p', 'h2', 'pre'])}>{k}" for k in range(6)) + "</div>") for _ in range(200)]
    pages = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], "page_id long, url string, html string")
    found = extraction.extracted(pages).collect()
    assert len(found) == len(rows) and not [r.page_id for r in found if not r.matched]


def test_extraction_cuts_nothing_in_an_article_that_does_not_say_so_as_a_whole(spark):
    parts = ["section id=related-work", "div class=search-results", "section id=social-history", "math", "svg", "object", "canvas", "noscript", "template"]
    body = "".join(f"<{p}><p>in {k}</p></{p.split()[0]}>" for k, p in enumerate(parts))
    gone = "<div class=ad>x</div><div id=comments-3>x</div><textarea>x</textarea><style>x</style>"
    rows = [
        (1, "http://a.example/", f"<article>{body}{gone}</article>"), (2, "http://b.example/", "<article><canvas>seen<p>too</article>"),
        (3, "http://c.example/", "<article><p>seen<script>x</article>"),
    ]
    found = {r.page_id: r.text for r in extraction.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == {1: "\n".join(f"in {k}" for k in range(len(parts))), 2: "seen\ntoo", 3: "seen"}


def test_wrappers_fold_repeats_and_hold_for_their_pages():
    stream = ["ul", "li", "#", "/li", "li", "#", "/li", "li", "#", "/li", "/ul"]
    assert wrappers.fold(stream) == ["ul", ("+", ("li", "#", "/li")), "/ul"]
    wrapper = wrappers.align(wrappers.fold(["p", "#", "/p", "hr"]), wrappers.fold(["p", "#", "/p", "p", "#", "/p"]))
    for page in (["p", "#", "/p", "hr"], ["p", "#", "/p", "p", "#", "/p"], ["p", "#", "/p"]):
        assert wrappers.match(wrapper, page) is not None
    assert wrappers.match(wrapper, ["hr", "p"]) is None
    both = wrappers.Wrapper(wrapper, {0: (True, False, False)})
    again = wrappers.Wrapper.load(both.dump())
    assert (again.nodes, again.labels) == (both.nodes, both.labels)
    assert html_module.unescape("&eacute;") == "é"


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, target, free = float(sum(sizes.values())), {}, set(names)
    while free:
        level = (total - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > most * sizes[s]}
        if not over:
            target.update({s: level * weight[s] for s in free})
            break
        target.update({s: float(most * sizes[s]) for s in over})
        free -= over
    return target


@pytest.mark.parametrize("shape", ["even", "capped", "tiny"])
def test_mixing_meets_its_targets(spark, shape):
    rng = random.Random(shape)
    counts = {"even": [40, 40, 40, 40], "capped": [2, 300, 3, 5, 1], "tiny": [1, 1]}[shape]
    rows, n = [], 0
    for s, count in enumerate(counts):
        for _ in range(count):
            rows.append((n, prose(rng, rng.randrange(1, 60)), None if s == 2 else f"é{s}"))
            n += 1
    rows += [(n, "", "empty only"), (n + 1, None, "empty only"), (None, "a b c", "é0"), (n + 2, "a\u00a0b c", "é0"), (n + 2, "a\u00a0b c", "é0")]
    docs = documents(spark, rows)
    found = mixing.mix(docs).collect()
    assert len(found) == len(rows)
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len((text or "").encode().split())
    target = brute_targets(sizes)
    taken = defaultdict(int)
    for r in found:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6
        assert 0 <= r.taken <= 3 * r.size and r.taken == sum(o["words"] for o in r.passes)
        assert all(0 <= o["position"] <= 1 for o in r.passes)
        taken[r.source] += r.taken
    for source in sizes:
        assert abs(taken[source] - target[source]) <= 1
    again = mixing.mix(docs.repartition(3)).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))
    order = [r.position for r in mixing.in_training_order(mixing.mix(docs)).collect()]
    assert order == sorted(order)
    assert mixing.mixed_documents(docs).columns == docs.columns
    assert mixing.mix(docs.limit(0)).count() == 0


def test_positions_invert_the_demand(spark):
    share = spark.range(101).select((F.col("id") / 100).alias("s"))
    for schedule in ((3.0, 1.0), (1.0, 1.0), (0.0, 2.0, 1.0)):
        for r in share.select("s", mixing.time_of(F.col("s"), schedule).alias("t")).collect():
            steps, done, whole = len(schedule) - 1, 0.0, 0.0
            for k in range(10000 if r.s in (0.25, 0.5) else 0):
                t = (k + 0.5) / 10000
                i = min(int(t * steps), steps - 1)
                w = schedule[i] + (schedule[i + 1] - schedule[i]) * (t * steps - i)
                whole += w
                done += w * (t < r.t)
            assert not whole or abs(done / whole - r.s) < 1e-3
            assert 0 <= r.t <= 1


def test_sharding_moves_rows_only_into_the_new_shard(spark):
    rows = [(i, f"text é {i % 7}", "s") for i in range(3000)] + [(None, None, "s"), (5, "", "s"), (5, "text é 5", "s")]
    found = sharding.place(documents(spark, rows), [1.0] * 8).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.grown_shard in (r.shard, 8) and 0 <= r.shard < 8
    assert 3000 / 9 * 0.8 < sum(r.grown_shard == 8 for r in found) < 3000 / 9 * 1.2
    for shard in range(8):
        assert sorted(r.slot for r in found if r.shard == shard) == list(range(sum(r.shard == shard for r in found)))
    assert len({r.shard for r in found if r.doc_id == 5}) == 1
    one = next(r for r in found if r.doc_id is None)
    assert (one.size, one.text_crc32) == (1, 0)
    assert all(r.text_crc32 == zlib.crc32(f"text é {r.doc_id % 7}".encode()) for r in found if r.doc_id not in (None, 5))
    heavy = sharding.place(documents(spark, rows), [1.0, 3.0]).groupBy("shard").count().collect()
    assert {r.shard: 2 < 4 * r["count"] / 3003 / (1, 3)[r.shard] * 2 < 3 for r in heavy} == {0: False, 1: False} or all(abs(r["count"] / 3003 - (0.25, 0.75)[r.shard]) < 0.03 for r in heavy)
    with pytest.raises(ValueError):
        sharding.shard_of(F.col("doc_id"), [1.0, 0.0])


def brute_url(url, table, default="allow"):
    if url is None or "://" not in url:
        return "", "", None, default
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fit = [(len(h + p), v, h + p) for h, p, v in table if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fit)[2], max(fit)[1]) if fit else (host, path, None, default)


def test_urls_against_brute_force(spark):
    rng = random.Random(8)
    hosts = ["example.net", "A.Example.NET", "xexample.net", "net", "example.com", "b.a.example.com", "x.org", "org", "", "a..net", "example.net:80", "é.org"]
    paths = ["", "/", "/en", "/en/", "/en/x", "/de/1?x=/fr/", "/fr/#a", "?q", "#f", "/e%6e/", "/fr/\u00e9", "/x://y/"]
    listed = [f"{s}://{h}{p}" for s in ("http", "") for h in hosts for p in paths] + [None, "", "example.net/en/", "mailto:x", "a\n://example.net/en/"]
    rng.shuffle(listed)
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(listed)] + [(None, listed[0], "x", "y")] * 2, "page_id long, url string, rule string, host string")
    table = [*URL_RULES, ("example.net", "/en", "block"), ("", "/", "block"), ("org", "/fr/\u00e9", "block"), ("org", "/fr/\u00e9", "allow")]
    for given in (URL_RULES, table):
        found = urls.judge_urls(pages, urls.rules_table(spark, given)).collect()
        assert len(found) == len(listed) + 2
        usable = [r for r in given if r[0]]
        for r in found:
            url = listed[0 if r.page_id is None else r.page_id]
            assert tuple(r)[1:] == brute_url(url, usable), url
    assert {r.verdict for r in urls.judge_urls(pages, urls.rules_table(spark, [])).collect()} == {"allow"}
    assert urls.judge_urls(pages.limit(0), urls.rules_table(spark, URL_RULES)).count() == 0


def test_bpe_is_that_of_the_library(spark):
    from tokenizers import Tokenizer

    rng = random.Random(9)
    alphabet = "aabbeetthh  \n\t'sSdll,.12éüß中文字😀\u00a0\u3000\x85\x1c\u200d́İ<|>"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(300)]
    texts += ["", None, "<|endoftext|>", "a<|endoftext|> b<|endoftext|", "a" * 5000, " " * 700, "aaab" * 300, "I'll we've 's 'S", "\x00\x01", prose(rng, 3000)]
    library = Tokenizer.from_file(vocabulary_path())
    docs = documents(spark, [*((i, t, "s") for i, t in enumerate(texts)), (None, "ab", "s"), (0, texts[0], "s")])
    encoded = bpe.encode(docs, vocabulary_path())
    found = bpe.decode(encoded, vocabulary_path()).collect()
    assert sorted(map(str, found)) == sorted(map(str, bpe.round_trip(docs, vocabulary_path()).collect()))
    assert len(found) == len(texts) + 2
    for r in found:
        text = "ab" if r.doc_id is None else texts[r.doc_id] or ""
        ids = library.encode(text, add_special_tokens=False).ids
        assert list(r.ids) == ids, repr(text)
        assert r.text == library.decode(ids, skip_special_tokens=False) == text
    assert bpe.encode(docs.limit(0), vocabulary_path()).count() == bpe.round_trip(docs.limit(0), vocabulary_path()).count() == 0


def counted_contexts(train_texts):
    counts = [defaultdict(Counter) for _ in range(ppm.ORDER + 1)]
    for t in train_texts:
        data = bytes([0xFE]) * ppm.ORDER + t + b"\xff"
        for i in range(ppm.ORDER, len(data)):
            for k in range(ppm.ORDER + 1):
                counts[k][data[i - k : i]][data[i]] += 1
    return counts


def brute_ppm(counts, text):
    """PPM with escape method C and exclusion, symbol by symbol."""
    data, total = bytes([0xFE]) * ppm.ORDER + text + b"\xff", 0.0
    for i in range(ppm.ORDER, len(data)):
        excluded, chance, symbol = set(), 1.0, data[i]
        for k in range(ppm.ORDER, -1, -1):
            seen = {s: n for s, n in counts[k][data[i - k : i]].items() if s not in excluded}
            whole = sum(seen.values()) + len(seen)
            if symbol in seen:
                chance *= seen[symbol] / whole
                break
            if seen:
                chance *= len(seen) / whole
            excluded |= set(seen)
        else:
            chance /= 256 - len(excluded)
        total += math.log10(chance)
    return total


@pytest.mark.parametrize("slice_nodes", [ppm.SLICE_NODES, 500])
def test_language_model_scores_against_brute_force(spark, slice_nodes):
    """In one slice and in several."""
    rng = random.Random(10)
    rows = [(i, prose(rng, rng.randrange(1, 40), 30) + rng.choice(["", " É", "\nX-Y"]), "s") for i in range(60)]
    rows += [(60, "", "s"), (61, None, "s"), (62, "never seen ~ \x7f words ÿ", "s"), (63, "w1 " * 70000, "s"), (None, "W1 w2", "s"), (5, rows[5][1], "s")]
    docs = documents(spark, rows)
    training = docs.where(~ppm.held_out(F.col("doc_id")))
    found = ppm.score_texts(docs, ppm.trained(training), slice_nodes).collect()
    assert len(found) == len(rows)
    texts = {i: (t or "").encode().lower() for i, t, _ in rows}
    learned = [(t or "").encode().lower() for i, t, _ in rows if i is None or zlib.crc32(str(i).encode()) % 7 != 2]
    seen = Counter(w for t in learned for w in [*t.split(), None])
    total, different = sum(seen.values()), len(seen)
    counts = counted_contexts(learned)
    for r in found:
        words = [*texts[r.doc_id].split(), None]
        base = sum(math.log10((seen[w] + 1) / (total + different + 1)) for w in words)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(seen[w] > 0 for w in words), total)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        if len(words) < 1000:
            assert r.score == pytest.approx(brute_ppm(counts, texts[r.doc_id]), rel=1e-9)
    none = ppm.score_texts(docs.where("doc_id = 62"), ppm.trained(docs.limit(0))).first()
    assert none.base_score == 0 and none.score == pytest.approx(-math.log10(256) * (len(texts[62]) + 1))
    assert ppm.score_texts(docs.limit(0), ppm.trained(docs)).count() == 0


def test_the_trie_never_passes_through_the_driver(spark, monkeypatch):
    rng = random.Random(13)
    docs = documents(spark, [(i, prose(rng, 40, 30), "s") for i in range(30)])
    counts = ppm.trained(docs)
    want = counted_contexts([r.text.encode() for r in docs.collect()])

    def refused(*_):
        raise AssertionError("the driver has the nodes")

    monkeypatch.setattr(type(docs), "toArrow", refused)
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", refused)
    monkeypatch.setattr(ppm, "LOOKUP_BYTES", 1)
    found = {r.doc_id: r.score for r in ppm.score_texts(docs, counts, 100).collect()}
    assert len(found) == 30
    for r in docs.collect():
        assert found[r.doc_id] == pytest.approx(brute_ppm(want, r.text.encode()), rel=1e-9)


def test_probabilities_of_a_context_add_up():
    import numpy as np

    codes, counts = ppm.added_up(*(lambda c: (c, np.ones(len(c))))(ppm.contexts([b"abracadabra", b"abrupt ending", b"banana"])[0]))
    short = ppm.levels(*ppm.added_up(ppm._last(codes, 3), counts), ppm.SHORT, [])
    trie = ppm.levels(codes, counts, ppm.ORDER, short)
    for context in (b"bracad"[-ppm.ORDER :], b"xxaban"[-ppm.ORDER :], b"zzzzza"[-ppm.ORDER :], b"\xfe" * ppm.ORDER, b"zzzzz"):
        start = int.from_bytes(context[-ppm.ORDER :], "big") << 8
        chances = 10 ** ppm.log_probabilities(trie, np.array([start | s for s in range(256)], dtype=np.uint64))
        assert chances.sum() == pytest.approx(1) and (chances > 0).all()


def test_edited_texts_and_their_fingerprints(spark):
    rng = random.Random(11)
    rows = [(rng.randrange(10**6) * 10 + i, prose(rng, rng.randrange(1, 90)), "s") for i in range(70)]
    rows += [(3, "", "s"), (4, None, "s"), (5, " \n ", "s"), (6, "é" * 100, "s"), (7, "abc", "s"), (8, "x y " * 3000, "s"), (9, rows[0][1], "s")]
    found = {r.doc_id: r for r in ordered_minhash.edited_fingerprints(documents(spark, rows)).collect()}
    assert len(found) == len(rows)
    ordered = sorted(rows, reverse=True, key=lambda r: r[0])
    for k, (i, text, _) in enumerate(ordered):
        text, following = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        cut = len(text) // 3
        want = text[: len(text) - cut] + following[:cut]
        assert (found[i].n_chars, found[i].edited_sha256) == (len(text), hashlib.sha256(want.encode()).hexdigest())
        assert (found[i].near_edited == 1) or text != want
        assert 0 <= found[i].near_next <= 1
    assert found[9].fingerprint == found[rows[0][0]].fingerprint
    plain = {r.doc_id: r.fingerprint for r in ordered_minhash.fingerprints(documents(spark, rows)).collect()}
    assert plain == {i: r.fingerprint for i, r in found.items()}


def test_fingerprints_of_repeated_rows_and_missing_ids(spark):
    rows = [(1, "a b c", "s"), (1, "a b c", "s"), (1, "d e f g h i", "s"), (None, "k l m", "s"), (None, None, "s")]
    found = ordered_minhash.edited_fingerprints(documents(spark, rows)).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(i) for i, *_ in rows)
    one = ordered_minhash.edited_fingerprints(documents(spark, rows[:1])).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"a b a").hexdigest() and one[0].near_next == 1
    assert ordered_minhash.edited_fingerprints(documents(spark, rows).limit(0)).count() == 0


def test_fingerprints_tell_order(spark):
    words = [f"w{i}" for i in range(200)]
    back = [w for k in range(0, 200, 4) for w in reversed(words[k : k + 4])]
    halves = words[100:] + words[:100]
    near = edited(random.Random(1), " ".join(words), 2)
    rows = [(1, " ".join(words), "s"), (2, " ".join(back), "s"), (3, " ".join(halves), "s"), (4, near, "s")]
    prints = ordered_minhash.fingerprints(documents(spark, rows))
    both = prints.alias("x").join(prints.where("doc_id = 1").alias("y"))
    like = {r.doc_id: r.n for r in both.select("x.doc_id", ordered_minhash.likeness(F.col("x.fingerprint"), F.col("y.fingerprint")).alias("n")).collect()}
    assert like[1] == 1 and like[4] > 0.7 and like[4] > like[3] > like[2]


def test_an_inserted_character_changes_few_kmers(spark):
    """In text without white space, in long words, and in texts of one or two words."""
    rng = random.Random(14)
    chinese = "".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(2000))
    code = " ".join("".join(rng.choice("abcdef0123456789+/") for _ in range(300)) for _ in range(5))
    pairs = [(chinese, "\u4e2d" + chinese), (code, "x" + code), ("international conference", "international conferences"), ("unbelievable", "unbelievably")]
    sized = prose(rng, 60)[:128]
    pairs += [("\U0001f600" * 3 + chinese, chinese), (sized, sized + "x"), (sized[:127], sized), (sized[:64], "x" + sized[:64])]
    prints = ordered_minhash.fingerprints(documents(spark, [(2 * k + j, t, "s") for k, pair in enumerate(pairs) for j, t in enumerate(pair)]))
    both = prints.alias("x").join(prints.alias("y"), F.expr("x.doc_id + 1 = y.doc_id AND x.doc_id % 2 = 0"))
    like = {r.doc_id // 2: r.n for r in both.select("x.doc_id", ordered_minhash.likeness(F.col("x.fingerprint"), F.col("y.fingerprint")).alias("n")).collect()}
    assert min(like[0], like[1], like[4]) > 0.9
    assert 0.4 < like[2] < 1 and like[3] < 1
    assert min(like[5], like[6]) > 0.7 and like[7] > 0.5
    runs = spark.range(1).select(ordered_minhash.runs_of(F.lit("a " * 100 + "b" * 7 + "cde f")).alias("r")).first().r
    assert runs == [*"a" * 100, "b" * 7 + "c", "b" * 6 + "cd", "b" * 5 + "cde", "f"]


def spark_hash(*values):
    """Spark's 64-bit xxHash of texts (UTF-8), 64-bit and 32-bit numbers; each seeds the next."""
    seed = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else v.to_bytes(8, "little", signed=True) if v < -(2**31) or v >= 2**31 or isinstance(v, Long) else v.to_bytes(4, "little", signed=True)
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed - (1 << 64) if seed >= 1 << 63 else seed


class Long(int):
    pass


def brute_fingerprint(text):
    runs = []
    for word in re.findall("[^\\x20\\x09-\\x0D]+", text):
        runs += [word] if len(word) <= 8 else [word[i : i + 8] for i in range(len(word) - 7)]
    if not runs:
        return "0" * 256
    mask, seen, circle = (1 << 28) - 1, Counter(), []
    for at in range(max(len(runs) - 1, 1)):
        kmer = tuple(runs[at : at + 2])
        circle.append(spark_hash(Long(spark_hash(*kmer) & ~mask), seen[kmer]) & ~mask | at)
        seen[kmer] += 1
    circle.sort()
    out = []
    for point in range(-(1 << 63), 1 << 63, 1 << 59):
        turned = [c for c in circle if c >= point] + [c for c in circle if c < point]
        one, two = sorted((turned * 2)[:2], key=lambda c: c & mask)
        out.append(f"{spark_hash(Long(one & ~mask), Long(two & ~mask)) % (1 << 64):016x}"[-8:].upper())
    return "".join(out)


def test_fingerprints_are_the_least_pairs_of_all_kmers(spark):
    rng = random.Random(15)
    texts = [prose(rng, rng.randrange(1, 120), 12) for _ in range(60)] + ["", " ", "a", "a a a a a a", "日本語のテキストは空白なしで続く。" * 9, "one verylongwordindeed é\U0001f600x", "a\x00b c\x0bd"]
    found = {r.doc_id: r.fingerprint for r in ordered_minhash.fingerprints(documents(spark, [(i, t, "s") for i, t in enumerate(texts)])).collect()}
    assert found == {i: brute_fingerprint(t) for i, t in enumerate(texts)}


def test_rows_without_ids_are_dealt_over_buckets(spark):
    rows = [(None, f"text {i} of many", "s") for i in range(500)] + [(1, "x", "s")]
    dealt = ordered_minhash._by_descending_id(documents(spark, rows).select("doc_id", "text"))
    assert dealt.groupBy("bucket").count().agg(F.max("count")).first()[0] < 20
    found = ordered_minhash.edited_fingerprints(documents(spark, rows)).collect()
    ordered = [(1, "x"), *sorted(((None, t) for _, t, _ in rows[:-1]), key=lambda r: hashlib.sha256(r[1].encode()).hexdigest())]
    want = Counter()
    for k, (i, text) in enumerate(ordered):
        cut = len(text) // 3
        want[i, hashlib.sha256((text[: len(text) - cut] + ordered[(k + 1) % len(ordered)][1][:cut]).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.edited_sha256) for r in found) == want


def test_sizes_of_very_long_texts_and_empty_tables(spark):
    long = "word " * 400_000
    docs = documents(spark, [(1, long, "s"), (2, "a b", "s"), (3, None, None)])
    placed = {r.doc_id: r for r in sharding.place(docs, [1.0] * 8).collect()}
    assert (placed[1].size, placed[1].text_crc32) == (len(long) + 1, zlib.crc32(long.encode()))
    assert {r.doc_id: r.size for r in mixing.mix(docs).collect()} == {1: 400_000, 2: 2, 3: 0}
    model = classifier.train(docs, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int"))
    assert {r.doc_id for r in classifier.score_documents(docs, model).collect()} == {1, 2, 3}
    nothing = docs.limit(0)
    assert sharding.place(nothing, [1.0] * 8).count() == mixing.mix(nothing).count() == classifier.score_documents(nothing, model).count() == 0
