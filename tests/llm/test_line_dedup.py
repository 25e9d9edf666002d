from fleetscope.llm import line_dedup
from tests.llm.helpers import AWKWARD, SCHEMA, documents, prose

LICENSE = "Licensed under the open terms of year 2021"


def rows(n=30):
    out = []
    for i in range(n):
        lines = [prose(i, 12), f"Posted by user{i} on day {i} of the month", f"Licensed under the open terms of year {1990 + i}", "",
                 prose(i + 500, 9)]
        out.append((100 + i, "\n".join(lines)))
    return out


def test_templates_with_varying_fields_go(spark):
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(documents(spark, rows())).collect()}
    for i in range(30):
        r = got[100 + i]
        assert r["text"] == f"{prose(i, 12)}\n\n{prose(i + 500, 9)}" and (r["n_lines"], r["n_dropped"]) == (5, 2)


def test_varying_words_without_digits(spark):
    names = "ann bob cid dan eva fay gus hal ida jim kai leo mia ned ola pat qui ron sue tim uma val wim xia yan".split()
    data = [(i, f"{prose(i, 7)}\nshared by the user called {n} from here") for i, n in enumerate(names)]
    got = line_dedup.dedup_lines(documents(spark, data)).collect()
    assert len(names) >= line_dedup.MIN_TEXTS and all(r["text"] == prose(r["doc_id"], 7) for r in got)


def test_rare_templates_and_repeats_within_one_document_stay(spark):
    line = lambda i: f"Licensed under the terms {i}"
    data = [(1, "\n".join([line(1)] * 50))] + [(2 + i, f"{prose(i, 9)}\n{line(i)}") for i in range(line_dedup.MIN_TEXTS - 2)]
    assert all(r["n_dropped"] == 0 for r in line_dedup.dedup_lines(documents(spark, data)).collect())
    data.append((99, f"\n{line(99)}\n{prose(99, 9)}"))
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(documents(spark, data)).collect()}
    assert got[1]["text"] == "" and got[1]["n_dropped"] == 50
    assert got[99]["n_lines"] == 3 and got[99]["text"] == f"\n{prose(99, 9)}" and got[7]["text"] == prose(5, 9)


def test_verbatim_lines_go_from_three_unlike_texts_on(spark):
    line = "Released under the MIT License, version 2.0"
    data = [(i, f"{prose(i, 9)}\n{line}\n{prose(50 + i, 8)}") for i in range(3)] + [(9, prose(9, 30))]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(documents(spark, data)).collect()}
    assert got == {9: prose(9, 30), **{i: f"{prose(i, 9)}\n{prose(50 + i, 8)}" for i in range(3)}}
    assert all(r["n_dropped"] == 0 for r in line_dedup.dedup_lines(documents(spark, data[1:])).collect())
    short = [(i, f"{prose(i, 9)}\nOf. The end") for i in range(9)]  # fewer words than such a line needs
    assert all(r["n_dropped"] == 0 for r in line_dedup.dedup_lines(documents(spark, short)).collect())


def test_copies_keep_their_prose(spark):
    own = "\n".join(prose(700 + i, 12) for i in range(6))
    data = [(i, own) for i in range(50)] + [(100 + i, f"{prose(i, 20)}\n{LICENSE}") for i in range(30)] + [(200, own + "\n" + LICENSE)]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(documents(spark, data)).collect()}
    assert all(got[i] == own for i in [*range(50), 200]) and all(got[100 + i] == prose(i, 20) for i in range(30))


def test_near_copies_keep_most_of_their_lines(spark):
    lines = [prose(700 + i, 12) for i in range(10)]
    data = []
    for i in range(40):  # each with a line of its own instead of one of the ten
        data.append((i, "\n".join(lines[:i % 10] + [prose(2000 + i, 12)] + lines[i % 10 + 1:])))
    data += [(100 + i, f"{prose(i, 20)}\n{LICENSE}\n{prose(300 + i, 7)}") for i in range(30)]
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(documents(spark, data)).collect()}
    assert all(got[i]["n_dropped"] < 5 for i in range(40)) and all(got[100 + i]["n_dropped"] == 1 for i in range(30))


def test_a_full_bitmap_drops_nothing_more(spark, monkeypatch):
    want = sorted(map(str, line_dedup.dedup_lines(documents(spark, rows())).collect()))
    monkeypatch.setattr(line_dedup, "BITMAP_WORDS", 1)
    assert sorted(map(str, line_dedup.dedup_lines(documents(spark, rows())).collect())) == want


def test_awkward_and_empty(spark):
    got = line_dedup.dedup_lines(documents(spark, AWKWARD)).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == sorted(((r[0], r[1]) for r in AWKWARD), key=str)
    assert all(r["n_dropped"] == 0 and (r["n_lines"] == 0) == (r["text"] is None) for r in got)
    assert line_dedup.dedup_lines(spark.createDataFrame([], SCHEMA)).collect() == []


def test_repeated_rows_count_as_one_document(spark):
    data = [(1, LICENSE)] * 40
    assert all(r["n_dropped"] == 0 for r in line_dedup.dedup_lines(documents(spark, data)).collect())


def test_no_python_in_the_plan(spark):
    plan = line_dedup.dedup_lines(documents(spark, rows(25)).select("doc_id", "text"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_unique_lines_of_one_opening_stay(spark):
    word = lambda i: "".join(chr(97 + i // 26 ** k % 26) for k in range(4))
    data = [(i, f"Is thndble {word(i)} {word(7 * i + 1)}.\n| {i} | {i * 7} |\nIs in {'the' if i < 30 else word(i)} {word(i + 999)}")
            for i in range(90)]
    assert all(r["n_dropped"] == 0 for r in line_dedup.dedup_lines(documents(spark, data)).collect())


def test_equal_lines_go_from_a_large_leaf(spark):
    word = lambda i: "".join(chr(97 + i // 26 ** k % 26) for k in range(4))
    data = [(i, f"{prose(i, 6)}\n{'All of it is reserved' if i < 20 else f'All of {word(i)} {word(i + 999)} {word(i + 5000)}'}\n* * *")
            for i in range(200)]
    got = line_dedup.dedup_lines(documents(spark, data)).collect()
    assert all(r["n_dropped"] == (2 if r["doc_id"] < 20 else 1) for r in got)


def test_common_words_behind_bare_signs_and_in_the_later_half(spark):
    signs = "".join(chr(97 + i) for i in range(26))
    data = [(i, f"{prose(i, 9)}\nRow of | | | | | alpha beta word{c}x\n{prose(60 + i, 8)}") for i, c in enumerate(signs)]
    data += [(100 + i, f"{prose(100 + i, 9)}\nSent by one{c} two{c} three to everybody\n{prose(200 + i, 8)}") for i, c in enumerate(signs)]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(documents(spark, data)).collect()}
    for i in range(26):
        assert got[i] == f"{prose(i, 9)}\n{prose(60 + i, 8)}"
        assert got[100 + i] == f"{prose(100 + i, 9)}\n{prose(200 + i, 8)}"
