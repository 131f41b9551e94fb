import random

from patronlens.llm.linededup import dedup_lines
from tests.llm.samples import AWKWARD, documents


def brute(rows):
    """(doc_id, text) -> text, lines, removed; rows have different ids here."""
    order = sorted((r for r in rows if r[1] is not None), key=lambda r: (r[0] is not None, r[0] or 0))
    seen, covered = set(), {}
    for doc_id, text in order:
        lines = [line.strip(" \t\r") for line in text.split("\n")]
        for i in range(len(lines) - 2):
            window = tuple(lines[i : i + 3])
            if "".join(window):
                if window in seen:
                    covered.setdefault(doc_id, set()).update(range(i, i + 3))
                seen.add(window)
    result = {}
    for doc_id, text in rows:
        lines = [] if text is None else text.split("\n")
        gone = covered.get(doc_id, set())
        kept = None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in gone)
        result[doc_id] = (kept, len(lines), len(gone))
    return result


def test_random_documents_equal_brute_force(spark):
    draw = random.Random(1)
    rows = [(i, "\n".join(draw.choice("abcd ") for _ in range(draw.randint(0, 12)))) for i in range(150)] + [(None, "a\nb\nc\nd")]
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in dedup_lines(documents(spark, rows).repartition(5)).collect()}
    assert got == brute(rows)
    assert any(removed for *_, removed in got.values())


def test_later_occurrences_go_and_the_first_stays(spark):
    rows = [(2, "x\na\nb\nc\ny"), (1, "a\nb\n c\t"), (3, "a\nb\nc\nz\nz"), (4, "a\nb")]
    got = {r.doc_id: r.text for r in dedup_lines(documents(spark, rows)).collect()}
    assert got == {1: "a\nb\n c\t", 2: "x\ny", 3: "z\nz", 4: "a\nb"}


def test_overlapping_windows_are_merged(spark):
    got = dedup_lines(documents(spark, [(1, "a\na\na\na\na")])).first()
    assert (got.text, got.n_lines, got.n_removed) == ("a", 5, 4)


def test_a_text_of_repeated_lines_only_becomes_empty(spark):
    got = {r.doc_id: r.text for r in dedup_lines(documents(spark, [(1, "a\nb\nc"), (2, "a\nb\nc")])).collect()}
    assert got == {1: "a\nb\nc", 2: ""}


def test_awkward_rows_and_clashing_columns(spark):
    df = documents(spark, AWKWARD, clashing=True)
    got = dedup_lines(df)
    assert got.columns == [*df.columns, "n_lines", "n_removed"]
    rows = got.collect()
    assert len(rows) == len(AWKWARD)
    assert all(r.row == "own row" and r.covered == "own covered" for r in rows)
    fives = [r for r in rows if r.doc_id == 5]
    assert fives[0] == fives[1] and fives[0].text.startswith("one two") and fives[0].n_removed == 3
    assert sorted(r.text for r in rows if r.doc_id == 6) == ["first of two", "second of two"]
    assert [r.text for r in rows if r.doc_id == 1] == [None]
    assert dedup_lines(df.limit(0)).collect() == []
