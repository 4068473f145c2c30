from collections import Counter

import pyarrow as pa

from lamplight.llm import scan_repair
from lamplight.llm.scan_repair import Channel, candidate_lines, found_items, paragraphs, repair, repair_scans

WORDS = {w: 5000 for w in "the of in was were and at".split()} | {w: 300 for w in "farmers watered seedlings between irrigation check growth moisture long-term plots clay day swine budding observed tenancy rice".split()}
CHANNEL = Channel(WORDS, {"of the": 500}, [1e-3] * 60)


def test_misread_words():
    for wrong, right in {"w@tered": "watered", "seedlin9s": "seedlings", "betvveen": "between", "cbeck": "check", "growtb": "growth", "moi5ture": "moisture", "observecl": "observed", "biidding": "budding", "svvine": "swine", "ten@ncy": "tenancy"}.items():
        assert CHANNEL.decode(["the", wrong, "of"])[1] == right
    for fine in ("day", "clay", "the", "Bakazu", "12", "Vol3", "x"):
        assert CHANNEL.decode([fine]) == [fine.lower()]


def test_cut_words():
    for left, right, word in (("water", "ed", "watered"), ("long", "term", "long-term"), ("Ba", "kazu", "bakazu"), ("moi5", "ture", "moisture")):
        assert CHANNEL.joined(left, right) == word


def test_repair():
    text = "The farmers were in the plots and wa-\n\n- 83 -\ntered the seedlin9s. The long-\nterm growth of\nrice was in the clay."
    drop = {i for i, *_ in candidate_lines(text.split("\n"))}
    assert drop == {2}
    items, fixed = repair(text, drop, CHANNEL)
    assert items == {("line", "- 83 -"), ("hyphen", "watered"), ("hyphen", "long-term"), ("misread", "seedlings")}
    assert "watered the seedlings. The long-term growth of rice" in fixed


def test_candidates_leave_tables_and_headings():
    table = ["rice  12  40", "soil  9  33", "8", "duck  7  1"]
    assert candidate_lines(table) == []
    assert candidate_lines(["Results", "", "The farmers were in the plots."]) == []
    assert candidate_lines(["Rice ........ 3", "Soil ........ 9"]) == []
    got = candidate_lines(["The farmers of the long and wide valley were", "ANNUAL BULLETIN No. 3", "watered by the rain."])
    assert [(i, key, form, cut) for i, key, form, cut, _ in got] == [(1, "annualbulletinno", 3, 1)]


def test_paragraphs():
    assert paragraphs("a\nb\r\n\r\nc\nx | 1 | 2\ny | 3 | 4") == "a b\n\nc\nx | 1 | 2\ny | 3 | 4"


def rows():
    body = "The farmers were in the plots near the river and\nthe seedlings were watered between the rows of\nclay in the morning of every day of the season."
    out = [("research", f"r{i}", f"s{i % 5}", f"{body}\n{body}") for i in range(80)]
    out += [("research", f"h{i}", "s1", body.replace("between the rows", f"betw-\nRIVER BULLETIN\n{i + 1}\neen the r0ws")) for i in range(6)]
    return out + [("files", "p", "s1", "{0}" + "-" * 48 + "\n\n- 27 -\n\n" + body.replace("watered", "w@tered")), ("files", "p", "s1", None), ("research", "b", None, " \n "), ("research", "e", "s", ""), ("research", "long", "s", body * 3000)]


def test_whole(spark):
    schema = "tab string, rec string, stem string, text string"
    df = spark.createDataFrame(rows() + rows()[-7:-4], schema).selectExpr("*", "1 as line", "2 as n")
    got = {(r.tab, r.rec, r.kind, r.item) for r in found_items(repair_scans(df)).collect()}
    want = {("files", "p", "line", "- 27 -"), ("files", "p", "misread", "watered")}
    for i in range(6):
        want |= {("research", f"h{i}", "line", "RIVER BULLETIN"), ("research", f"h{i}", "line", str(i + 1)), ("research", f"h{i}", "hyphen", "between"), ("research", f"h{i}", "misread", "rows")}
    assert got == want
    assert repair_scans(df.where("false")).count() == 0


def test_counts_do_not_depend_on_batches(monkeypatch):
    texts = ["The rain of Bakazu fell.", "The rice of the valley was in the rain.", "A farmer of Bakazu in the rain.", "rain, the rain of Bakazu"] * 3
    text_batch = lambda some: pa.RecordBatch.from_arrays([pa.array(range(len(some)), pa.int64()), pa.array(["s"] * len(some)), pa.array(some)], ["uid", "stem", "text"])

    def counts(step):
        total = Counter()
        for batch in scan_repair._survey(iter([text_batch(texts[i : i + step]) for i in range(0, len(texts), step)])):
            for r in batch.to_pylist():
                total[r["what"], r["word"]] += r["n"]
        return total

    whole = counts(len(texts))
    assert whole["pair", "of bakazu"] == 9 and whole["pair", "farmer of"] == 3 and whole["word", "rain"] == 15
    assert counts(1) == whole
    monkeypatch.setattr(scan_repair, "PARTIAL_COUNTS", 10)
    assert counts(1) == whole


def test_page_numbers_in_words():
    for line in ("page 12 of 140", "Page 12 of 140.", "page 112 of 140;", "Page 12 of 140"):
        got = candidate_lines(["The farmers of the long and wide valley were", line, "watered by the rain."])
        assert [(i, form) for i, _, form, *_ in got] == [(1, 1)]


def test_bounds_are_told(spark, monkeypatch, caplog):
    rows = spark.createDataFrame([("research", str(i), "s", "The rice of the valley and the rain of the hills.") for i in range(6)], "tab string, rec string, stem string, text string")
    repair_scans(rows).collect()
    assert not caplog.records
    monkeypatch.setattr(scan_repair, "VOCABULARY", 2)
    repair_scans(rows).collect()
    assert [r.args[:2] for r in caplog.records if r.name == scan_repair.__name__] == [("words", 2), ("bigrams", 4)]


def test_result_does_not_depend_on_partitions(spark):
    df = spark.createDataFrame(rows(), "tab string, rec string, stem string, text string")
    one, many = ({tuple(r) for r in found_items(repair_scans(df.repartition(n))).collect()} for n in (1, 64))
    assert one and one == many


def test_left_part_of_any_length():
    left = "hydro" * 30
    assert [x[1] for x in scan_repair._cuts(f"the {left}-\nlogical survey")] == [left]


def test_contents_keep_their_signed_page_numbers():
    lines = [f"Chapter on rice {i}   {i}" for i in range(3, 10)] + ["- 12 -"]
    assert [x[0] for x in candidate_lines(lines)] == [7]


def test_what_memory_does_not_hold_counts_too(spark, monkeypatch):
    df = spark.createDataFrame(rows(), "tab string, rec string, stem string, text string")
    result = lambda: {(r.tab, r.rec, r.repaired, frozenset(map(tuple, r.found))) for r in repair_scans(df).collect()}
    want = result()
    assert any(kind == "misread" for *_, found in want for kind, _ in found)
    for most in (1, 5):
        monkeypatch.setattr(scan_repair, "VOCABULARY", most)
        assert result() == want
