import random

import numpy as np
import pytest
from pyspark.sql import DataFrame

from marlstone.llm import near_dedup as nd

CLASHING = ["kept", "component_id", "node", "key", "text_a"]


def brute(rows, width=3, similarity=85):
    sets = {k: nd.shingle_set(t, width) for k, t in rows}
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    ids = sorted(k for k in sets if sets[k])
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            common = len(sets[a] & sets[b])
            if 100 * common >= similarity * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in sets}


def changed(text, seed, n):
    words, draw = text.split(), random.Random(seed)
    for i in draw.sample(range(len(words)), n):
        words[i] = f"new{seed}x{i}"
    return " ".join(words)


def check(docs, rows, width=3, similarity=85):
    got = nd.near_duplicates(docs, width=width, similarity=similarity).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, width, similarity)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(rows)


def cases(prose):
    rows = [(1000 + i, prose(i, 80)) for i in range(60)]
    rows += [(i, changed(prose(1, 120), i, i % 5)) for i in range(200)]           # one large group, links at the limit
    rows += [(300 + i, changed(prose(2, 200), 7 * i, 2 * (i % 12))) for i in range(60)]
    rows += [(400 + i, "Short  Text" if i % 2 else "short text") for i in range(20)]
    return [*rows, (500, None), (501, ""), (502, " \n"), (503, "one"), (504, "ONE"), (505, "É x y"), (506, "é x y"),
            (507, prose(3, 20_000)), (508, changed(prose(3, 20_000), 1, 300))]


def test_against_all_pairs(spark, documents, prose):
    rows = cases(prose)
    check(documents(rows, CLASHING), rows)


def test_small_blocks(spark, documents, prose, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 16)
    monkeypatch.setattr(nd, "NEIGHBOURS", 1)
    rows = cases(prose)[60:320]
    check(documents(rows), rows)


def test_shingles_bound_a_block_too(spark, documents, prose, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK_SHINGLES", 1000)
    rows = cases(prose)[60:320]
    check(documents(rows), rows)


def test_trees_follow_the_limit():
    for similarity in (60, 75, 80, 85, 95, 100):
        missed = (1 - min(similarity / 100, 0.99) ** nd.ROOT) ** nd.trees_for(similarity)
        assert missed <= nd.MISSED
        assert 0 < nd.least_agreeing(similarity) <= nd.trees_for(similarity) * nd.ROOT
    assert nd.trees_for(85) == 16


def test_low_limit(spark, documents, prose):
    base = prose(9, 60)
    rows = [(i, changed(base, i, i % 12)) for i in range(60)] + [(100 + i, prose(200 + i, 60)) for i in range(20)]
    check(documents(rows), rows, 3, 55)


def written_rows(monkeypatch, run):
    """Rows that go into the blocks of open regions."""
    seen, grouped = [], DataFrame.sortWithinPartitions

    def counting(self, *columns, **kwargs):
        if columns[:3] == ("key", "block", "probe_block"):
            seen.append(self.count())
        return grouped(self, *columns, **kwargs)

    monkeypatch.setattr(DataFrame, "sortWithinPartitions", counting)
    run()
    monkeypatch.undo()
    return sum(seen)


def test_rows_of_texts_below_the_limit_stay_linear(spark, documents, prose, monkeypatch):
    """Texts of one template, all just below the limit: twice as many send at most about twice as many rows."""
    base, counts = prose(11, 150), []
    for n in (1000, 2000):
        rows = [(i, changed(base, i, 9)) for i in range(n)]
        monkeypatch.setattr(nd, "BLOCK", 64)
        found = []
        counts.append(written_rows(monkeypatch, lambda: found.extend(nd.near_duplicates(documents(rows)).collect())))
        assert all(r.kept for r in found) and len(found) == n
    assert counts[1] <= 2.5 * max(counts[0], n)


def test_a_block_counts_what_sets_have_in_common():
    draw = random.Random(3)
    sets = [np.unique(np.array([draw.randrange(20) for _ in range(25)], "<u8")) for _ in range(40)]
    rows = [{"node": bytes([i]), "component": bytes([i % 11]), "digests": s.tobytes()} for i, s in enumerate(sets)]
    block = nd.Block(rows[:30], 60)
    for probe in sets[30:]:
        assert block.common(probe).tolist() == [len(set(probe) & set(s)) for s in sets[:30]]
    # Each probe links with one target of every component it is similar to, and never twice with the same.
    linked = {}
    for r, own in zip(rows[30:], sets[30:]):
        similar = {t["component"] for t, s in zip(rows[:30], sets) if 100 * len(set(own) & set(s)) >= 60 * len(set(own) | set(s))}
        got = [rows[n[0]]["component"] for n in block.links(r)]
        assert len(got) == len(set(got)) and set(got) <= similar - {r["component"]}
        linked[r["node"]] = got
    assert any(linked.values())


def test_other_width_and_limit(spark, documents, prose):
    rows = cases(prose)[:320]
    check(documents(rows), rows, 5, 80)


def test_repeated_rows_and_null_ids(spark, documents, prose):
    text = prose(5, 50)
    docs = documents([(2, text), (2, text), (None, text), (7, text), (8, "other words here")])
    rows = sorted((str(r.doc_id), str(r.component_id), r.kept) for r in nd.near_duplicates(docs).collect())
    assert rows == [("2", "2", True), ("2", "2", True), ("7", "2", False), ("8", "8", True), ("None", "None", True)]


@pytest.mark.parametrize("rows", [[], [(1, None)]])
def test_nothing_to_link(spark, documents, rows):
    assert nd.near_duplicates(documents(rows)).count() == len(rows)


def test_components_of_a_long_chain(spark):
    n = 200
    links = spark.createDataFrame(
        [(i.to_bytes(2, "big"), (i + 1).to_bytes(2, "big")) for i in random.Random(1).sample(range(n), n)],
        "a binary, b binary")
    got = nd.components_of(links).collect()
    assert len(got) == n and {bytes(r.component) for r in got} == {b"\0\0"}


def test_components_are_whole_when_keyed_partitions_are_raised(spark, monkeypatch):
    repartition = DataFrame.repartition
    monkeypatch.setattr(DataFrame, "repartition", lambda self, n, *cols: repartition(
        self, max(n, 7) if cols and isinstance(n, int) else n, *cols))
    ids = [bytes([k]) for k in range(60)]
    chain = [(a, b) for a, b in zip(ids, ids[1:]) if a[0] % 20 != 19]
    random.Random(3).shuffle(chain)
    found = nd.components_of(spark.createDataFrame(chain, "a binary, b binary")).collect()
    assert sorted((r.node[0], r.component[0]) for r in found) == [(k, k - k % 20) for k in range(60) if k % 20]
