"""Ranked search, conversation repair and language identification against brute force, and on edge cases."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

from clearspan.llm import conversations, fptree, langid, queries

SMALL = Path("/root/testdata/sf0.01")
needs_tables = pytest.mark.skipif(not SMALL.exists(), reason="test tables are absent")

# --- ranked search ---------------------------------------------------------------------------------

TERM = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, n long, terms string, item_id int, score long, `__item` int"
ITEMS = "item_id long, text string, doc_id long, rank int"


def terms(text):
    return TERM.findall((text or "").translate(ASCII_LOWER))


def brute_search(docs, items, top=10):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    texts, length = sum(1 for _, c in counts if c), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    found = []
    for item, text in items:
        scores = []
        for doc, c in counts:
            m = 10 + 90 * c.total() * texts // max(length, 1)
            score = 0
            for t in set(terms(text)):
                if c[t]:
                    score += math.floor(1000 * math.log((2 * texts + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        found += [(item, rank, doc, -s) for rank, (s, _, _, doc) in enumerate(sorted(scores, key=lambda x: x[:3])[:top], 1)]
    return sorted(found, key=repr)


def searched(spark, docs, items, **more):
    d = spark.createDataFrame([(i, t, 1, "x", 2, 3, 4) for i, t in docs], DOCS)
    q = spark.createDataFrame([(i, t, 9, 8) for i, t in items], ITEMS)
    return sorted((tuple(r) for r in fptree.search(d, q, **more).select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def skewed_text(rng, n):
    return " ".join(f"T{min(int(rng.paretovariate(0.7)), 300)}" for _ in range(n))


def test_search_equals_scoring_all(spark):
    rng = random.Random(1)
    docs = [(i, skewed_text(rng, rng.choice([0, 1, 5, 40, 200]))) for i in range(400)]
    docs += [(1000 + i, docs[7][1] + " t7") for i in range(90)] + [(3, "T1 T2"), (3, "T1 T2"), (None, "T1 T2 t9"), (5000, None), (5001, ""), (5002, " .,- "), (5003, "Été naïve ÉTÉ x_y-z 日本")]
    items = [(k, skewed_text(rng, rng.choice([1, 4, 30]))) for k in range(25)]
    items += [(90, None), (91, ""), (92, "absent"), (93, "été Y Z"), (93, "T1"), (None, "T2 t2 T3")]
    assert searched(spark, docs, items) == brute_search(docs, items)


def test_search_prunes_across_leaves_and_trees(spark, monkeypatch):
    monkeypatch.setattr(fptree, "TREE_ROWS", 64)
    monkeypatch.setattr(fptree, "LEAF_ROWS", 4)
    monkeypatch.setattr(fptree, "BLOCK_TERMS", 30)
    monkeypatch.setattr(fptree, "PIECE_BYTES", 16)
    rng = random.Random(2)
    docs = [(i, skewed_text(rng, rng.choice([3, 20, 60]))) for i in range(300)] + [(900 + i, "t1 t2 t3 t4") for i in range(40)]
    items = [(k, skewed_text(rng, 12)) for k in range(12)] + [(50, "T1 t2 t3 t4")]
    assert searched(spark, docs, items, top=3) == brute_search(docs, items, top=3)


def test_tree_visits_few_leaves():
    """A rare term leads to its leaf alone once the best are known."""
    rng = random.Random(3)
    docs = [[0, 1 + rng.randrange(20), 30 + rng.randrange(300)] for _ in range(2000)]
    for d in docs[:10]:
        d.append(999)
    ends = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    tree = fptree.Tree(list(range(2000)), np.full(2000, 100), ends, np.array([t for d in docs for t in d]), np.ones(ends[-1], dtype=np.int64))
    seen = []
    score = tree._scored
    tree._scored = lambda leaf, *more: seen.append(leaf) or score(leaf, *more)
    best = tree.search(np.array([0, 999]), np.array([1, 9000]), [], 10)
    assert sorted(doc for _, _, doc in best) == list(range(10))
    assert 10 <= len(seen) < len(tree.leaves) // 2


def test_search_on_empty_tables_and_long_texts(spark):
    assert searched(spark, [], [(1, "a")]) == []
    assert searched(spark, [(1, "a")], []) == []
    long = "word " * 300_000 + "rare"
    docs = [(1, long), (2, "rare"), (3, "word")]
    assert searched(spark, docs, [(1, "rare word"), (2, long)]) == brute_search(docs, [(1, "rare word"), (2, long)])


# --- conversation repair -----------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, times int, `group` string, known boolean, cost int"
GRAMMAR = re.compile("(s?(ua)+)?")
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def brute_edits(rows):
    """The lightest (cost, audit) and its turns, by trying edits up to a cost that is raised step by step."""
    n = len(rows)

    def tried(i, left, made):
        """All derivations of the turns from i on that cost at most left: cost, audit, turns."""
        if i == n:
            yield 0, "", made
        if i < n:
            role, text, must_go, cut = rows[i]
            if left >= 3:
                for c, a, m in tried(i + 1, left - 3, made):
                    yield c + 3, "D" + a, m
            if not must_go:
                if left >= cut:
                    for c, a, m in tried(i + 1, left - cut, [*made, (role, text)]):
                        yield c + cut, "K" + a, m
                if left >= 2 + cut:
                    for to in ("user", "assistant"):
                        for c, a, m in tried(i + 1, left - 2 - cut, [*made, (to, text)]):
                            yield c + 2 + cut, "R" + a, m
        if left >= 2:
            for to in ("user", "assistant"):
                for c, a, m in tried(i, left - 2, [*made, (to, "")]):
                    yield c + 2, "I" + a, m

    for limit in itertools.count():
        good = [(c, a, m) for c, a, m in tried(0, limit, []) if GRAMMAR.fullmatch("".join(r[:1] or " " for r, _ in m))]
        if good:
            return min(good)


def brute_repair(rows):
    """rows: (turn, role, text) of one conversation after damage, nulls as spaces, in order."""
    seen, marked, counts = set(), [], Counter()
    for turn, role, text in rows:
        blank, again = not BLANK.search(text), (role, text) in seen
        seen.add((role, text))
        last = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
        cut = last not in (".", "!", "?")
        counts["blank"] += blank
        counts["duplicate"] += again and not blank
        counts["truncated"] += cut and not again and not blank
        marked.append((role, text, blank or again, int(cut and not blank and not again)))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    numbers = [t for t, _, _ in rows if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    cost, audit, made = brute_edits(marked)
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
    return gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest


def in_order(rows):
    key = lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(r[2].encode()).hexdigest(), r[1])
    return sorted(rows, key=key)


def brute_table(rows):
    grouped = defaultdict(list)
    for conv, turn, role, text, times in rows:
        grouped[conv] += [(turn, " " if role is None else role, " " if text is None else text)] * times
    return sorted(((c, *brute_repair(in_order(r))) for c, r in grouped.items()), key=repr)


def repaired(spark, rows):
    df = spark.createDataFrame([(*r, "x", True, 5) for r in rows], TURNS)
    return sorted((tuple(r) for r in conversations.repair(df).collect()), key=repr)


def random_turns(rng, conv, n):
    rows = []
    for k in range(n):
        role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", None])
        text = rng.choice(["Yes.", "No!", "cut short", "", " \n", None, "Why? ", f"t{rng.randrange(4)}."])
        rows.append((conv, rng.choice([None, k, k, k + 1, 7]), role, text, rng.choice([1, 1, 1, 1, 0, 2])))
    return rows


def test_repairs_are_the_lightest_of_all(spark):
    rng = random.Random(4)
    rows = [r for conv in range(60) for r in random_turns(rng, conv, rng.randrange(1, 6))]
    rows += [(None, 0, "user", "Hi.", 1), (None, 1, "assistant", "Ho.", 1), (700, 0, "user", "x", 0), (701, 5, "user", "Hi.", 1), (701, -3, "sys", "S.", 1)]
    assert repaired(spark, rows) == brute_table(rows)


def test_repairs_do_not_depend_on_pieces(spark, monkeypatch):
    rng = random.Random(5)
    rows = [r for conv in range(6) for r in random_turns(rng, conv, 60)]
    rows += [(50, 3, "user", "again", 70), (50, 4, "assistant", "Well.", 1)]
    rows += [(51, k % 2, rng.choice(["user", "assistant"]), f"Turn {k}.", 1) for k in range(200)]
    whole = repaired(spark, rows)
    for name, value in (("PIECE", 3), ("TURNS", 4), ("CROWDED", 10)):
        monkeypatch.setattr(conversations, name, value)
    assert repaired(spark, rows) == whole
    assert len(whole) == 8


def test_combined_facts_equal_one_agenda():
    rng = random.Random(6)
    for _ in range(300):
        turns = [(rng.choice("suax"), rng.random() < 0.2, rng.random() < 0.2) for _ in range(rng.randrange(1, 14))]
        cuts = sorted(rng.sample(range(1, len(turns)), rng.randrange(0, len(turns))) if len(turns) > 1 else [])
        parts = [turns[a:b] for a, b in zip([0, *cuts], [*cuts, len(turns)])]
        facts = [[conversations.lightest(p, s) for s in range(conversations.STATES)] for p in parts]
        whole = conversations.lightest(turns, conversations.START)
        assert conversations.combined(facts) == min(whole[s] for s in conversations.GOAL if whole[s])


def test_repaired_turns_follow_the_audit(spark):
    rows = [(1, 0, "assistant", "A.", 1), (1, 1, "user", "U", 1), (1, 2, "user", "", 1), (2, 0, "user", "x", 0)]
    df = spark.createDataFrame([(*r, "x", True, 5) for r in rows], TURNS)
    report = {r.conv_id: r for r in conversations.repair(df).collect()}
    made = sorted(tuple(r) for r in conversations.repaired_turns(df).collect())
    assert [m[1] for m in made] == list(range(len(made)))
    text = "\n".join(f"{role}:{text}" for _, _, _, role, text in made)
    assert report[1].repaired_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert report[2][1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert GRAMMAR.fullmatch("".join(m[3][0] for m in made))
    assert conversations.repair(df.limit(0)).count() == 0


def test_damage_follows_the_checksum(spark):
    rows = [(c, t, "assistant", "One. Two!") for c in (1, 2, None) for t in (None, *range(30))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = Counter(tuple(r) for r in conversations.damaged(df).collect())
    want = Counter()
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        want[c, t, "user" if kind == 4 else role, {1: "", 2: "One Two"}.get(kind, text), {0: 0, 3: 2}.get(kind, 1)] += 1
    assert got == want


def test_long_conversations(spark):
    rows = [(1, k, "user" if k % 2 == 0 else "assistant", f"Turn {k}." + ("x" * 200_000 + "." if k == 5 else ""), 1) for k in range(3000)] + [(1, None, "system", "S.", 1)]
    (row,) = repaired(spark, rows)
    text = "system:S.\n" + "\n".join(f"{r}:{t}" for _, _, r, t, _ in rows[:-1])
    assert row[1:] == (0, 0, 0, 0, 0, 0, "K" * 3001, hashlib.sha256(text.encode()).hexdigest())


# --- language identification ---------------------------------------------------------------------------

LANG = "doc_id long, text string, lang string, score double, pick long, machine int, lang_pred string"
SOUNDS = {"en": "the of and th sh wh ing", "de": "der sch und ich ung ein", "fr": "les eau que é oi eux", "es": "los ñ que ción rr ez", "xx": "zq kx vv qj"}


def spoken(rng, language, n):
    return " ".join("".join(rng.choice(SOUNDS[language].split()) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def language_table(spark, rows):
    return spark.createDataFrame([(i, t, lang, 0.5, 1, 2, "no") for i, t, lang in rows], LANG)


def test_languages_of_several_families(spark):
    rng = random.Random(7)
    rows = [(i, spoken(rng, lang, 30), lang) for i, lang in enumerate(itertools.islice(itertools.cycle(SOUNDS), 200))]
    model = langid.train(language_table(spark, rows))
    assert model.families == {"germanic": ["de", "en"], "romance": ["es", "fr"], "xx": ["xx"]}
    assert set(model.machines) == {("", "germanic", "romance"), ("", "germanic", "xx"), ("", "romance", "xx"), ("germanic", "de", "en"), ("romance", "es", "fr")}
    fresh = [(1000 + i, spoken(rng, lang, 12), lang) for i, lang in enumerate(itertools.islice(itertools.cycle(SOUNDS), 100))]
    found = {r.doc_id: r for r in langid.predict_languages(language_table(spark, fresh), model).collect()}
    assert sum(found[i].lang_pred == lang for i, _, lang in fresh) >= 98
    assert all(0 <= r.score <= 1 for r in found.values())


def test_language_edge_cases(spark):
    rows = [(1, "the wh sh ing", "en"), (2, "der sch und", "de"), (2, "der sch und", "de"), (3, None, "en"), (4, "", "de"), (5, "123 !?", "fr"), (6, "les eau", None), (None, "der sch ich", "de")]
    model = langid.train(language_table(spark, rows))
    assert model.families == {"germanic": ["de", "en"]}
    asked = [(1, None, "en"), (2, "", "en"), (2, "12 .,\n", "en"), (None, "sch der", "fr"), (4, "É", None), (5, "wh sh " * 400_000, "de")]
    got = {(r.doc_id, r.held_out): (r.lang_pred, r.score) for r in langid.predict_languages(language_table(spark, asked), model).collect()}
    assert got[1, zlib.crc32(b"1") % 4 == 2] == ("und", 0.0) and got[2, zlib.crc32(b"2") % 4 == 2] == ("und", 0.0)
    assert got[None, False][0] == "de" and got[5, zlib.crc32(b"5") % 4 == 2][0] == "en"
    nothing = langid.train(language_table(spark, rows).limit(0))
    assert {r.lang_pred for r in langid.predict_languages(language_table(spark, rows), nothing).collect()} == {"und"}
    alone = langid.train(language_table(spark, [(1, "the", "en")]))
    assert {(r.lang_pred, r.score) for r in langid.predict_languages(language_table(spark, [(1, "x", "de")]), alone).collect()} == {("en", 1.0)}
    assert langid.predict_languages(language_table(spark, rows).limit(0), model).count() == 0


def test_language_pieces_do_not_change_features(monkeypatch):
    rng = random.Random(8)
    texts = [spoken(rng, "fr", 50), "x", "", "é" * 40]
    whole = langid.features(texts)
    monkeypatch.setattr(langid, "PIECE_BYTES", 7)
    assert (langid.features(texts) == whole).all()


def test_language_ignores_labels_of_the_held_out_fold(spark):
    rng = random.Random(9)
    rows = [(i, spoken(rng, lang, 20), lang) for i, lang in enumerate(["en", "de"] * 30)]
    docs = language_table(spark, rows)
    held = docs.where(langid.held_out(docs["doc_id"])).count()
    assert 0 < held < 60
    one = langid.train(docs.where(~langid.held_out(docs["doc_id"])))
    flipped = language_table(spark, [(i, t, {"en": "de", "de": "en"}[lang] if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in rows])
    two = langid.train(flipped.where(~langid.held_out(flipped["doc_id"])))
    assert all((one.machines[k] == two.machines[k]).all() for k in one.machines)


@needs_tables
def test_held_out_accuracy_of_languages(spark):
    docs = spark.read.parquet(str(SMALL / "documents.parquet"))
    found = queries.QUERIES["op13_language_id"](spark, str(SMALL)).join(docs.select("doc_id", "lang"), "doc_id").where("held_out AND lang_pred <> 'und'").collect()
    assert len(found) > 100
    assert sum(r.lang == r.lang_pred for r in found) >= 0.97 * len(found)
