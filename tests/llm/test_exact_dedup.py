import hashlib
import re

from marlstone.llm.exact_dedup import content_sort_dedup

CLASHING = ["kept", "keep_id", "group_size", "text_sha256", "row", "norm"]


def brute(rows):
    norm = {k: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for k, t in rows}
    out = set()
    for k, _ in rows:
        same = [j for j, n in norm.items() if n == norm[k]]
        out.add((k, min(same), len(same), k == min(same), hashlib.sha256(norm[k].encode()).hexdigest()))
    return out


ROWS = [
    (5, "a b"), (3, "a  b"), (9, "a\t\nb"), (1, "a b "), (2, None), (4, ""), (6, " "), (7, "\n\n"),
    (8, "A b"), (10, "x" * 200_000), (11, "x" * 200_000), (12, "a b"),
    *[(100 + i, "copy of\n many") for i in range(60)],
]


def test_groups(spark, documents):
    got = content_sort_dedup(documents(ROWS), carry=False)
    assert {tuple(r) for r in got.collect()} == brute(ROWS)


def test_hot_text_is_cut_into_pieces(spark, documents):
    whole = content_sort_dedup(documents(ROWS), carry=False)
    cut = content_sort_dedup(documents(ROWS), carry=False, hot_copies=4, hot_share=8)
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, whole.collect()))


def test_clashing_columns_and_repeated_rows(spark, documents):
    docs = documents([*ROWS, (3, "a  b"), (3, "a  b")], CLASHING)
    got = content_sort_dedup(docs, hot_copies=4, hot_share=8)
    kept = got.where("kept").select("row.*")
    assert kept.columns == docs.columns
    assert kept.where("doc_id = 3").count() == 1 and kept.count() == len({r[4] for r in brute(ROWS)})


def test_null_identifiers(spark, documents):
    got = content_sort_dedup(documents([(None, "a"), (4, "a"), (None, "b"), (None, "b")]), carry=False)
    rows = sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in got.collect())
    assert rows == [("4", "4", 2, True), ("None", "4", 2, False), ("None", "None", 2, False), ("None", "None", 2, True)]


def test_empty_table(spark, documents):
    assert content_sort_dedup(documents([])).count() == 0


def test_text_is_shuffled_once(spark, documents):
    plan = content_sort_dedup(documents(ROWS), carry=False)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("rangepartitioning") == 1 and "hashpartitioning" not in plan
    assert "Python" not in plan
