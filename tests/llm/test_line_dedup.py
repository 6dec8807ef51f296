import random
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeproof.llm import line_dedup as ld


def brute(rows, least):
    """A line goes if a run of lines around it, of enough words, stands in an earlier document."""
    order = sorted({(d is None, d or 0, ld_hash, t) for d, ld_hash, t in rows if t is not None})
    out, seen = {}, []
    for none, doc, _, text in order:
        lines = ld.lines_of(text)
        words, gone = [len(x.encode().split()) for x in lines], set()
        for a in range(len(lines)):
            for b in range(a + 1, len(lines) + 1):
                run = tuple(lines[a:b])
                if sum(words[a:b]) >= least and any(run == e[i:i + len(run)] for e in seen for i in range(len(e))):
                    gone.update(range(a, b))
        out[none, doc, text] = sorted(gone)
        seen.append(tuple(lines))
    return out


def rows_of(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return [(r.doc_id, r.h, r.text) for r in df.withColumn("h", F.xxhash64("text")).collect()], df


def made(seed, docs=60):
    r = random.Random(seed)
    pool = [" ".join(r.choice("abcdefg") for _ in range(r.randint(1, 6))) for _ in range(40)]
    passage = [r.choice(pool) for _ in range(5)]
    out = []
    for i in range(docs):
        lines = [r.choice([r.choice(pool), f"own {i} {r.random()} words", ""]) for _ in range(r.randint(0, 9))]
        if r.random() < 0.4:
            at = r.randint(0, len(lines))
            lines[at:at] = passage[r.randint(0, 2):]
        out.append((i if i % 9 else None, "\n".join(lines)))
    return out + out[:5] + [(1000 + i, out[3][1]) for i in range(30)]


def common_runs(x, words, y, least):
    """All runs ``(a, b)`` of enough words of ``x`` that stand in ``y``."""
    return [(a, b) for a in range(len(x)) for b in range(a + 1, len(x) + 1)
            if sum(words[a:b]) >= least and any(x[a:b] == y[i:i + b - a] for i in range(len(y)))]


def test_against_brute_force(spark):
    """Only lines of repeated runs go, and no repeated run is left whole."""
    for seed, least in ((1, 4), (2, 8), (3, 12)):
        rows, df = rows_of(spark, made(seed))
        want = brute(rows, least)
        lines = ld.lined(df, least).dropDuplicates(["doc_id", "text_hash"])
        marked = {(r.doc_id, r.text_hash): set(r.gone) for r in ld.deletions(lines, least).collect()}
        hashes = {(d is None, d or 0, t): (d, h) for d, h, t in rows}
        seen = []
        for key in sorted(want, key=lambda k: (k[0], k[1], hashes[k][1])):
            mine = ld.lines_of(key[2])
            gone = marked.get(hashes[key], set())
            assert gone <= set(want[key])
            words = [len(x.encode().split()) for x in mine]
            for a in range(len(mine)):
                for b in range(a + 1, len(mine) + 1):
                    if sum(words[a:b]) >= least and not gone.intersection(range(a, b)):
                        assert not any(mine[a:b] == e[i:i + b - a] for e in seen for i in range(len(e)))
            seen.append(mine)
        # The texts are those without the marked lines, one row for each row.
        got = Counter((r.doc_id, r.text, r.n_lines, r.n_deleted, r.n_deleted_words)
                      for r in ld.dedup_lines(df, least).collect())
        assert got == Counter((d, *ld.without(t, list(marked.get((d, h), ())))) for d, h, t in rows)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=14), st.lists(st.integers(0, 6), max_size=14), st.integers(1, 6))
def test_one_pair(x, y, least):
    words = [1 + v % 3 for v in x]
    gone = set(ld.common_blocks(x, words, y, least))
    common = common_runs(x, words, y, least)
    assert gone <= {i for a, b in common for i in range(a, b)}
    assert all(gone.intersection(range(a, b)) for a, b in common)


@given(st.lists(st.integers(0, 5), max_size=12), st.lists(st.integers(0, 5), max_size=12), st.integers(1, 6))
def test_patience_aligns_blocks_in_order(x, y, least):
    words = [1 + v % 3 for v in x]
    blocks = sorted(ld.patience(x, words, y, 0, len(x), least))
    for i, j, n in blocks:
        assert x[i:i + n] == y[j:j + n] and sum(words[i:i + n]) >= least
    assert all(i + n <= k and j + n <= m for (i, j, n), (k, m, _) in zip(blocks, blocks[1:], strict=False))


def test_the_alignment_decides_what_goes():
    """Runs that overlap: the aligned one goes, what is left of the other is too short."""
    x, y = [1, 2, 3, 4], [3, 4, 9, 1, 2, 3]
    words = [4, 4, 4, 4]
    assert {i for a, b in common_runs(x, words, y, 8) for i in range(a, b)} == {0, 1, 2, 3}
    assert ld.common_blocks(x, words, y, 8) == [0, 1, 2]
    # Blocks that cross over, and blocks that repeat, go as well.
    assert ld.common_blocks([1, 2, 3, 4], words, [3, 4, 9, 1, 2], 8) == [0, 1, 2, 3]
    assert ld.common_blocks([1, 2, 7, 1, 2], [4] * 5, [1, 2, 8, 1, 2, 8, 1, 2], 8) == [0, 1, 3, 4]
    assert ld.common_blocks([], [], y, 8) == ld.common_blocks(x, words, [], 8) == []


def test_a_passage_in_many_documents_stays_once(spark):
    passage = "a passage of twelve words or more that stands in every document here"
    rows = [(i, f"line of document {i} alone\n{passage}\nlast of {i}") for i in range(500)]
    got = ld.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r.doc_id for r in got if passage in r.text] == [0]
    assert all(f"last of {r.doc_id}" in r.text for r in got)


def test_edges(spark, edge):
    got = ld.dedup_lines(edge, 5, carry=("row", "gone"))
    assert got.columns == ["doc_id", "text", "n_lines", "n_deleted", "n_deleted_words", "row", "gone"]
    rows = got.collect()
    assert len(rows) == edge.count()
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    assert by[2][0].text is None and by[3][0].text == "" and [r.n_deleted for r in by[5]] == [2]
    assert [r.n_deleted for r in by[1]] == [0, 0]
    assert ld.dedup_lines(edge.where(F.lit(False))).count() == 0
