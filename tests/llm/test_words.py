"""Operators on words and n-grams against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from obsgate.llm import common as C
from obsgate.llm import fragments as P
from obsgate.llm.components import components
from obsgate.llm.decontaminate import drop_contaminated
from obsgate.llm import jaccard_join as J
from obsgate.llm.jaccard_join import frequent_keys, jaccard_components, one_per_group
from obsgate.llm.quality_rules import keep_good, longest_repeats, quality_rules
from obsgate.llm.substring_dedup import substring_dedup


def words(t):
    return [w.decode("utf-8", "surrogatepass") for w in (t or "").encode().split()]


# --- operator 1


def longest_by_hand(ws, least):
    out = []
    for i in range(len(ws)):
        best = 0
        for j in range(len(ws)):
            n = 0
            while i != j and max(i, j) + n < len(ws) and ws[i + n] == ws[j + n]:
                n += 1
            best = max(best, n)
        out.append(best if best >= least else 0)
    return out


def test_longest_repeats_match_brute_force():
    rng = random.Random(5)
    for _ in range(100):
        docs = [[rng.choice("abc") for _ in range(rng.randint(0, 40))] for _ in range(4)]
        hashes, offsets = C.word_hashes([[w.encode() for w in d] for d in docs])
        symbols = C.mix(hashes + C.doc_of(offsets).astype(np.uint64) * np.uint64(C._M[0]))
        least = rng.choice([1, 2, 3, 7])
        assert longest_repeats(symbols, least).tolist() == sum((longest_by_hand(d, least) for d in docs), [])


def base_by_hand(text):
    ws = words(text)
    grams = Counter(tuple(ws[i : i + 3]) for i in range(len(ws) - 2))
    repeated = {j for i in range(len(ws) - 2) if grams[tuple(ws[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    failed = len(ws) < 50 or 100 * len(repeated) > 50 * len(ws)
    return (len(ws), sum(map(len, ws)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeated), failed)


@pytest.mark.parametrize("which", ["documents", "edges"])
def test_quality_rules(request, which):
    df, rows = request.getfixturevalue(which)
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality_rules(df).collect()), key=str)
    assert got == sorted(((i, *base_by_hand(t)) for i, t in rows), key=str)


def test_quality_verdict(spark, empty):
    rng = random.Random(1)
    prose = lambda n: " ".join(f"v{rng.randrange(10**9)}" for _ in range(n))
    passage = prose(120)
    df = spark.createDataFrame([(1, prose(300)), (2, passage + " " + prose(400) + " " + passage), (3, " ".join([prose(12)] * 2 + [prose(30)]))], "doc_id long, text string")
    rows = {r.doc_id: r for r in quality_rules(df).collect()}
    assert rows[1].kept and rows[1].covered_words == 0
    assert not rows[2].kept and rows[2].longest_repeat == 120 and rows[2].covered_words == 240 and not rows[2].base_failed
    assert rows[3].longest_repeat == 0 or rows[3].covered_words == 24
    assert [r.doc_id for r in keep_good(df).collect()] == [1]
    assert quality_rules(empty).count() == 0 and keep_good(empty).columns == empty.columns


# --- operator 9


def removed_by_hand(rows, window=20):
    last = 2**63
    docs = {}
    for i, t in rows:
        docs.setdefault(last if i is None else i, set()).add(t)
    first = {}
    for i in sorted(docs):
        for t in docs[i]:
            ws = words(t)
            for s in range(len(ws) - window + 1):
                key = tuple(ws[s : s + window])
                first[key] = min(first.get(key, (i, s)), (i, s))
    out = []
    for i, t in rows:
        ws = words(t)
        gone = set()
        for s in range(len(ws) - window + 1):
            if first[tuple(ws[s : s + window])] < (last if i is None else i, s):
                gone.update(range(s, s + window))
        kept = " ".join(w for j, w in enumerate(ws) if j not in gone)
        out.append((i, len(ws), len(gone), hashlib.sha256(kept.encode("utf-8", "surrogatepass")).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("which", ["documents", "edges"])
def test_substring_dedup(request, which):
    df, rows = request.getfixturevalue(which)
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup(df).collect()]
    assert sorted(got, key=str) == removed_by_hand(rows)


def test_substring_dedup_random(spark, empty):
    rng = random.Random(3)
    passages = [[rng.choice("abcdefgh") for _ in range(rng.randint(15, 50))] for _ in range(6)]
    rows = []
    for i in range(120):
        ws = []
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            lo = rng.randint(0, 10)
            ws += p[lo : lo + rng.randint(10, 50)] + [f"n{rng.randrange(9)}" for _ in range(rng.randint(0, 3))]
        rows.append((i, " ".join(ws)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup(df).collect()]
    assert sorted(got, key=str) == removed_by_hand(rows)
    assert substring_dedup(empty).count() == 0


def test_substring_dedup_rows_without_id_or_sharing_one(spark):
    """Rows are judged by themselves: what repeats nowhere stays, whatever another row of the same id has at its place."""
    text = lambda c, n=30: " ".join(f"{c}{i}" for i in range(n))
    rows = [(1, text("p")), (None, text("p")), (None, text("u")), (None, text("q")), (7, text("s")), (7, text("t")), (8, "x " + text("s")), (9, text("v")), (9, text("v")), (None, text("z") + " a"), (None, text("z") + " b")]
    got = sorted(((r.doc_id, r.n_words, r.n_removed) for r in substring_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()), key=str)
    assert got == sorted([(1, 30, 0), (None, 30, 30), (None, 30, 0), (None, 30, 0), (7, 30, 0), (7, 30, 0), (8, 31, 30), (9, 30, 0), (9, 30, 0), (None, 31, 0), (None, 31, 30)], key=str)


# --- operator 8


def lower(t):
    return [w.encode().lower() for w in words(t)]


def components_by_hand(rows):
    sets = {}
    for i, t in rows:
        ws = lower(t)
        sets[i] = {tuple(ws[j : j + 5]) for j in range(len(ws) - 4)} if len(ws) >= 5 else ({tuple(ws)} if ws else set())
    owners = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            owners[g].append(i)
    both = Counter((a, b) for o in owners.values() for x, a in enumerate(o) for b in o[x + 1 :])
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in both.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {(i, len(s), root(i)) for i, s in sets.items()}


def test_jaccard_components(documents):
    df, rows = documents
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(df).collect()} == components_by_hand(rows)


def test_jaccard_edges(edges, empty):
    df, rows = edges
    got = jaccard_components(df).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == components_by_hand([r for r in rows if r[0] is not None])
    assert {(r.n_shingles, r.component_id) for r in got if r.doc_id is None} == {(56, 1), (0, None)}
    kept = one_per_group(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [1, 4, 5, 6, 7, 11, 12]  # 10 ends in the base text
    assert jaccard_components(empty).count() == 0 and one_per_group(empty).count() == 0


def test_jaccard_links_rows_without_id(spark):
    base = [f"w{i}" for i in range(60)]
    near = lambda *at: " ".join("x" if i in at else w for i, w in enumerate(base))
    rows = [(3, near(59)), (None, near()), (None, near(0)), (9, near(0, 1)), (None, "other words of a row that nothing is like"), (None, None)]
    got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.component_id or 0, r.n_shingles) for r in got) == [(0, 0), (0, 5), (3, 56), (3, 56), (3, 56), (3, 56)]
    assert all(r.links for r in got if r.component_id)


def test_columns_named_as_the_helpers(spark):
    text = " ".join(f"w{i}" for i in range(60))
    names = ["doc_id", "text", "_out", "_hit", "_id", "_set", "_node", "_again", "row", "node", "key", "id", "set", "component", "component_id"]
    rows = [(i, t, *range(len(names) - 2)) for i, t in ((1, text), (2, text), (2, text), (4, "item words " + text), (5, "something else altogether"), (None, text))]
    df = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} int" for n in names[2:]))
    assert (got := one_per_group(df)).columns == names and sorted(r.doc_id or 0 for r in got.collect()) == [0, 1, 5]
    assert [r._node for r in got.collect()] == [names[2:].index("_node")] * 3
    items = spark.createDataFrame([(1, text)], "item_id long, text string")
    assert (got := drop_contaminated(df, items)).columns == names and sorted(r.doc_id or 0 for r in got.collect()) == [0, 5]


def test_frequent_list_is_cut_inside_a_level(spark):
    df = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(k, k + 40))) for i, k in enumerate([0] * 40 + [100] * 40 + [200] * 40)], "doc_id long, text string")
    whole = frequent_keys(df, 5, 4, most=1000)
    some = frequent_keys(df, 5, 4, most=50)
    assert len(whole) == 108 and 20 < len(some) < 80 and set(some) < set(whole)
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(df).collect()} == {(i, 36, i // 40 * 40) for i in range(120)}


def test_one_per_group_with_shared_ids(spark):
    text = lambda c: " ".join(f"{c}{i}" for i in range(60))
    near = lambda c: text(c).replace(f"{c}59", "changed")
    rows = [(1, text("a")), (2, near("a")), (5, near("a")), (5, text("b")), (5, text("c")), (5, text("b")), (7, text("d")), (7, near("d")), (8, near("b")), (9, ""), (9, None), (9, text("e")), (None, text("a"))]
    kept = [(r.doc_id, r.text) for r in one_per_group(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    sevens = [t for i, t in kept if i == 7]
    assert len(sevens) == 1 and sevens[0] in (text("d"), near("d"))
    assert sum(i == 9 and not t for i, t in kept) == 1
    assert sorted((i or 0, t) for i, t in kept if i != 7 and t) == [(0, text("a")), (1, text("a")), (5, text("b")), (5, text("c")), (9, text("e"))]


def test_jaccard_large_groups(spark):
    """Near copies in numbers over the pairing limit, and documents near some of them only."""
    rng = random.Random(9)
    base = [f"b{i}" for i in range(80)]
    rows = []
    for i in range(150):
        ws = list(base)
        for _ in range(rng.randint(0, 2)):
            ws[rng.randrange(80)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(ws)))
    rows += [(1000 + i, " ".join(base[:60] + [f"y{i}-{j}" for j in range(6)])) for i in range(60)]
    rows += [(2000 + i, " ".join([f"z{i}"] + base[20:] + [f"q{i % 7}"] * 3)) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for many in (4, 32):
        got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(df, many=many).collect()}
        assert got == components_by_hand(rows)


def test_jaccard_shared_passage(spark):
    """Documents of one passage and own words in all proportions: long lists that hold many components."""
    rng = random.Random(4)
    passage = [f"p{i}" for i in range(90)]
    rows = [(i, " ".join(passage[rng.randrange(3):] + [f"o{i}-{j}" for j in range(rng.randrange(50))])) for i in range(140)]
    rows += [(1000 + i, " ".join([f"h{i % 9}-{j}" for j in range(rng.randrange(25))] + passage)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = components_by_hand(rows)
    assert len({c for _, _, c in want}) > 20
    for many in (2, 32):
        assert {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(df, many=many).collect()} == want


def test_jaccard_counts_every_link(spark, monkeypatch):
    """Near copies over the pairing limit: each one's links to all others, also where lists are cut into blocks."""
    rng = random.Random(6)
    base = [f"b{i}" for i in range(90)]
    rows = []
    for i in range(130):
        ws = base[rng.randrange(4) : 90 - rng.randrange(9)]
        for _ in range(rng.randint(0, 3)):
            ws[rng.randrange(len(ws))] = f"x{rng.randrange(40)}"
        rows.append((i, " ".join(ws)))
    rows += [(500 + i, t) for i, t in rows[:10]]  # copies
    sets = {i: frozenset(tuple(ws[j : j + 5]) for j in range(len(ws) - 4)) for i, t in rows for ws in [t.split()]}
    distinct = set(sets.values())
    degree = {x: sum(x != y and 100 * len(x & y) >= 80 * len(x | y) for y in distinct) for x in distinct}
    want = {(i, degree[s]) for i, s in sets.items()}
    assert max(d for _, d in want) > 40
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    monkeypatch.setattr(J, "CELL", 30)
    monkeypatch.setattr(J, "LIST_ROWS", 200)
    for many in (4, 32):
        got = jaccard_components(df, many=many).collect()
        assert {(r.doc_id, r.links) for r in got} == want
        assert {(r.doc_id, r.n_shingles, r.component_id) for r in got} == components_by_hand(rows)


def test_long_lists_meet_by_size(spark, monkeypatch):
    """Cells of any size give just the pairs that the bounds allow; the leaders' pairs are among them."""
    monkeypatch.setattr(J, "CELL", 3)
    rng = random.Random(2)
    nodes = [(i, n := rng.randint(10, 400), n - rng.randrange(n // 5 + 1), rng.choice((i, 500, 500, 501))) for i in range(300)]
    held = spark.createDataFrame([(i % 2, i, n, rest) for i, n, rest, _ in nodes], "list long, node long, n long, rest long")
    groups = spark.createDataFrame([(i, c) for i, _, _, c in nodes], "node long, component long")
    firsts = spark.createDataFrame([(i, [0] * 16) for i, *_ in nodes], "node long, bits array<long>")
    rows = J._open_lists(held, groups, firsts, 80)
    able = lambda a, b: min(a[2], b[2]) * 180 >= 80 * (a[1] + b[1])
    own = {x: Counter(c for i, _, _, c in nodes if i % 2 == x).most_common(1)[0][0] for x in (0, 1)}
    want = {(a[0], b[0], a[1], b[1]) for a in nodes for b in nodes if a[0] < b[0] and a[0] % 2 == b[0] % 2 and a[3] != b[3]
            and min(a[1], b[1]) * 100 >= 80 * max(a[1], b[1]) and able(a, b) and not a[3] == b[3] == own[a[0] % 2]}
    got = [tuple(r) for r in J._in_cells(rows, 80).collect()]
    assert len(want) > 500 and set(got) == want and len(got) == len(want)
    led = {tuple(r) for r in J._with_leaders(rows, 80).collect()}
    assert led and led < want


def test_jaccard_counts_links_without_pairs(spark, monkeypatch):
    """Near copies: pairs that become rows stay in proportion to the documents, their links are counted whole."""
    base = [f"b{i}" for i in range(200)]
    pairs, links_of = [], J._links

    def noted(met, *a):
        pairs.append(met.count())
        return links_of(met, *a)

    monkeypatch.setattr(J, "_links", noted)
    made = {}
    for m in (60, 240):
        del pairs[:]
        rows = [(i, " ".join(base[:i % 50] + [f"x{i}"] + base[i % 50 + 1:])) for i in range(m)]
        got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
        assert {(r.component_id, r.links) for r in got} == {(0, m - 1)}
        made[m] = sum(pairs)
    assert made[240] < 20 * 240 and made[240] < 8 * made[60]


def test_jaccard_counted_links_are_the_listed_ones(spark, monkeypatch):
    """Number of links by cells of all sizes against the list of links, with short documents, copies and chains."""
    rng = random.Random(12)
    rows = []
    for c in range(6):
        ws = [f"c{c}-{i}" for i in range(rng.choice((12, 60, 150)))]
        for _ in range(60):  # each near the one before
            ws = list(ws) + [f"e{rng.randrange(10**6)}"] * rng.randrange(2)
            if rng.random() < 0.5:
                ws[rng.randrange(len(ws) // 2, len(ws))] = f"y{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(ws)))
    rows += [(5000, rows[3][1]), (None, rows[3][1]), (None, rows[70][1] + " more"), (None, None), (5001, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    sets, links, _ = J.jaccard_links(df, many=8)
    ends = Counter(d for r in links.collect() for d in (r.a, r.b))
    want = Counter((r.doc_id, ends[r.node]) for r in sets.collect())
    assert len(links.select("a", "b").distinct().collect()) * 2 == sum(ends.values())
    for cell, grams in ((2_000, 1_000_000), (7, 1_000_000), (2_000, 3_000)):
        monkeypatch.setattr(J, "CELL", cell)
        monkeypatch.setattr(J, "CELL_GRAMS", grams)
        assert Counter((r.doc_id, r.links) for r in jaccard_components(df, many=8).collect()) == want


def test_nodes_of_like_sizes_share_one_cell(spark, monkeypatch):
    monkeypatch.setattr(J, "CELL", 20)
    rng = random.Random(3)
    nodes = [(i, rng.randint(1, 400), 900 + i // 200) for i in range(205)]
    cells = defaultdict(list)
    for r in J._places(spark.createDataFrame(nodes, "node long, n long, component long"), 80).collect():
        cells[r.cell].append(r)
    met = Counter((min(x.node, y.node), max(x.node, y.node)) for c in cells.values() for x in c for y in c if x.node != y.node and (x.same and x.node < y.node or not x.same and y.side and not x.side))
    like = {(a[0], b[0]) for a in nodes for b in nodes if a[0] < b[0] and a[2] == b[2] and 100 * min(a[1], b[1]) >= 80 * max(a[1], b[1])}
    assert set(met.values()) == {1} and like <= set(met) and all(nodes[a][2] == nodes[b][2] for a, b in met)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 130)] + [(5, i) for i in range(6, 40)] + [(39, 131), (7, 7), (200, 201), (201, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 131)}, **{i: 5 for i in [*range(5, 40), 131]}, 200: 200, 201: 200}


def test_packed_keys():
    for n in (0, 1, 5, 1000):
        x = np.sort(np.random.default_rng(n).integers(0, 1 << 24, n))
        assert P.unpack_steps(P.pack_steps(x)).tolist() == x.tolist()
        y = np.random.default_rng(n).integers(0, 1 << 40, n).astype(np.uint64)
        assert P.unpack40(P.pack40(y)).tolist() == y.tolist()
