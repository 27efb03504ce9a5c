"""Scanned pages: kinds of lines and repaired text."""

from lexaloom.llm import scans

CLEAN = "The quick remote buffer merges every single matrix before the next step and each private module counts its hand-written graph while the reader restores the model with little effort " * 3
PAGE = "\n".join([
    "The remote buffer merges every single ma-",
    "trix before the next step and each priv-",
    "- 12 -",
    "TESTING GRAPHS",
    "ate module counts its hand-",
    "written graph whi1e the reader restores",
    "thc model with little effort.",
    "",
    "The quick module counts every matrix and",
    "restores the buffer.",
    "- 13 -",
])
COLS = "section_id long, source_type string, title string, content string, metadata map<string,string>"


def table(spark, *more):
    return spark.createDataFrame([(1, "url", "x", CLEAN, None), (2, "pdf", "Testing Graphs", PAGE, {"ocr": "true"}), *more], COLS)


def test_kinds(spark):
    got = {(r.section_id, r.line_no, r.kind) for r in scans.line_kinds(table(spark)).collect()}
    assert got == {(2, 1, "hyphen"), (2, 2, "hyphen"), (2, 3, "page_number"), (2, 4, "header"), (2, 6, "misread"), (2, 7, "misread"), (2, 11, "page_number")}


def test_repair(spark):
    got = {r.section_id: r.text for r in scans.repaired(table(spark)).collect()}
    assert got[2] == (
        "The remote buffer merges every single matrix before the next step and each private module counts its hand-written graph while the reader restores the model with little effort."
        "\n\nThe quick module counts every matrix and restores the buffer."
    )


def test_edges(spark):
    x = table(spark, (3, "pdf", None, None, None), (4, "pdf", "t", "", {"ocr": "true"}), (5, None, "t", "one line", None), (2, "pdf", "Testing Graphs", PAGE, {"ocr": "true"}), (None, "pdf", "t", PAGE, None), (6, "pdf", "t", "w " * 20000, {"ocr": "true"}))
    assert {r.section_id for r in scans.line_kinds(x).collect()} == {2}
    assert scans.repaired(x).where("section_id = 2").count() == 1
    assert scans.line_kinds(x.limit(0)).count() == 0


def test_confusions():
    r = scans.Reader({"while": 9, "module": 9, "the": 50, "function": 5}, {})
    assert [r.misread(w) for w in ("whi1e", "rnodule,", "fiinction", "the", "v1.2", "12", "Xy")] == ["while", "module", "function", None, None, None, None]
    assert scans.value("xiv") == 14 and scans.value("l98") == 198 and scans.value("12") == 12


def test_two_errors_in_a_word_like_a_name():
    like = "^rcmotc$"
    r = scans.Reader({"remote": 9}, {like[i : i + 3]: 2 for i in range(len(like) - 2)})
    assert r.misread("Rcmotc") == "Remote"


def test_rows_of_tables_are_no_headers(spark):
    rows = "\n".join(["| key | note | value |", "| --- | --- | --- |", *[f"| Nam{chr(97 + i % 26)}r | 编译器用自己的方法分配知识点 | {i} |" for i in range(30)]])
    x = table(spark, (7, "pdf", "t", rows, None), (8, "pdf", "t", rows, {"ocr": "true"}))
    assert {r.section_id for r in scans.line_kinds(x).collect()} == {2}


def test_joint_decoding():
    """Blanks that are missing, too many or misplaced, beside confusions and hyphens."""
    words = {w: 20 for w in "the information cat sat of on mat computer module reader formation in remote buffer".split()}
    r = scans.Reader(words | {"the": 500, "of": 300, "on": 200, "in": 200}, {})
    read = lambda *lines: r.repair(list(lines), [set() for _ in lines])
    assert read("the infor mation of the cat") == "the information of the cat"
    assert read("ofthe cat") == "of the cat"
    assert read("th ecat sat on the rnat") == "the cat sat on the mat"
    assert read("the cornputerrnodule sat") == "the computer module sat"
    assert read("the rernote buf-", "fer sat on") == "the remote buffer sat on"


def test_dictionary_does_not_depend_on_batches(spark):
    rng = __import__("random").Random(1)
    name = lambda: rng.choice("KLMN") + "".join(rng.choice("abcdefghij") for _ in range(6))
    x = spark.createDataFrame([(i, "url", None, " ".join(["a word and", name(), name(), "more words here"]), None) for i in range(300)], COLS)
    out = []
    for size in ("10", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        out.append({tuple(r) for r in scans.dictionary(x).collect()})
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    assert out[0] == out[1] and any(k == "t" for k, _, _ in out[0])


def test_readings_without_limit():
    """A long token with very many readings is still read."""
    r = scans.Reader({"internationalisierungsmoeglichkeiten": 5}, {})
    assert r.misread("lnternationa1isierungsrnoeglichkeiten") == "internationalisierungsmoeglichkeiten"
