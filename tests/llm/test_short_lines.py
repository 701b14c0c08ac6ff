"""Repeats and near copies of short lines."""

from tidemark.llm import line_dedup


def test_short_repeats_go_and_blank_lines_stay(spark):
    rows = [(1, "Read more\n\nHome\n \t\nxyz\nRead more"), (2, "Home\n\nRead more\nRead mora\n\r\n1\n \t"), (3, "xyz"), (None, "1\nnew")]
    out = {r.doc_id: r for r in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[1].text == "Read more\n\nHome\n \t\nxyz" and out[2].text == "\n\r\n1\n \t"
    assert (out[3].text, out[3].n_dropped) == ("", 1) and out[None].text == "new"


def test_one_edit():
    words = ["", "a", "b", "ab", "ba", "abc", "acb", "abcd", "x" * 600, "x" * 599, "x" * 300 + "y" + "x" * 299, "y" + "x" * 599, "x" * 601 + "yz"]

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(row[-1] + 1, last[j] + 1, last[j - 1] + (x != y)))
        return row[-1]

    assert all(line_dedup.within_one_edit(a, b) == (distance(a, b) <= 1) for a in words for b in words)
