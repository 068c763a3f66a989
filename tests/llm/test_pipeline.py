"""The pipeline against its stages worked out by hand on a small corpus."""

import random
from collections import Counter, defaultdict

import corpus_pipeline as P
from tests.llm.test_words import base_by_hand, components_by_hand, longest_by_hand, words

from obsgate.llm.line_dedup import MAX_PCT, MIN_PAGES
from obsgate.llm.quality_rules import MAX_COVERED, MAX_LONGEST, MIN_REPEAT


def corpus():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghik") for _ in range(rng.randint(2, 8)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [(i, prose(20 + i)) for i in range(4)]
    rows = []
    for i in range(60):
        text = "\n".join(prose(20) for _ in range(4))
        if i % 3 == 0:
            text = f"shared line of source {i % 2}\n{text}"
        if i % 7 == 0:
            text += "\n" + items[i % 4][1].upper() + " " + prose(3)
        if i % 11 == 0:
            text = prose(10)
        if i % 13 == 0:
            text = (prose(30) + " ") * 4
        if i % 17 == 5:
            text = rows[i - 1][1].replace("a", "b", 1)
        rows.append((i, text, "en", f"s{i % 2}", len(text)))
    rows += [(100, rows[1][1], "en", "s0", 0), (101, None, "en", None, 0), (102, "", None, "s1", 0), (100, rows[1][1], "en", "s0", 0)]
    return rows, items


def by_hand(rows, items):
    def good(t):
        ws = words(t)
        best = longest_by_hand(ws, MIN_REPEAT)
        covered = {j for i, n in enumerate(best) for j in range(i, i + n)}
        return not base_by_hand(t)[-1] and max(best, default=0) <= MAX_LONGEST and len(covered) <= MAX_COVERED * len(ws)

    rows = [r for r in rows if good(r[1])]
    pages, holding = Counter(r[3] for r in rows), Counter((r[3], x) for r in rows for x in set(r[1].split("\n")) if words(x))
    bad = {k for k, n in holding.items() if n >= MIN_PAGES and 100 * n > MAX_PCT * pages[k[0]]}
    rows = [(r[0], "\n".join(x for x in r[1].split("\n") if (r[3], x) not in bad), *r[2:]) for r in rows]
    group = {i: c for i, _, c in components_by_hand([r[:2] for r in rows])}
    rows = list({r[0]: r for r in rows if group[r[0]] == r[0]}.values())
    norm = lambda t: [w.strip(".,!").lower() for w in words(t)]
    inside = lambda a, b: any(b[i : i + len(a)] == a for i in range(len(b) - len(a) + 1))
    return {r[0]: r[1] for r in rows if not any(inside(norm(t), norm(r[1])) for _, t in items)}


def test_stages_and_run(spark, tmp_path):
    rows, items = corpus()
    sf = f"file://{tmp_path}"
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in P.STAGES[:-1]:
        docs = P.C.stage(stage(spark, docs, sf), f"test-{name}")
        assert docs.columns == columns
        seen.append(docs.count())
    want = by_hand(rows, items)
    assert {r.doc_id: r.text for r in docs.collect()} == want
    assert len(rows) > seen[0] >= seen[1] > seen[2] > seen[3] == len(want) > 10
    pieces = P.run(spark, sf).collect()
    sizes = defaultdict(int)
    for p in pieces:
        sizes[p.doc_id] += p.length
    assert set(sizes) == set(want) and all(sizes[p.doc_id] == p.doc_tokens for p in pieces)
