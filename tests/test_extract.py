"""Workbook decoding and template extraction (golden values, negative cases)."""

import json

import pytest
from pyspark.sql import functions as F

from tessera.operators.extract import Extraction
from tessera.sources.workbook import decode_workbook, encode_workbook, read_cells
from workbooks import company_a, company_b


def _parse(spark, books: dict):
    files = spark.createDataFrame([(name, encode_workbook(b)) for name, b in books.items()],
                                  "filename string, content binary")
    rows = Extraction(read_cells(files)).payloads().collect()
    return {r.filename: r for r in rows}


@pytest.fixture(scope="module")
def parsed(spark):
    books = {
        "corporates_A_1.xlsm": company_a(),
        "corporates_B_1.xlsm": company_b(),
        "bad.xlsm": company_a(extra=[(100, 26, "string", "unexpected_noise")]),
        "stray.xlsm": company_a(extra=[(100, 26, "string", "stray comment"), (5, 1, "string", "unexpected header")]),
        "missing.xlsm": company_a(drop=("Rated entity",)),
        "nosheet.xlsm": {"Sheet1": [(1, 1, "string", "x")]},
        "locked_elsewhere.xlsm": company_a(extra=[(10, 4, "string", "Locked")]),
    }
    return _parse(spark, books)


def test_company_a_golden_values(parsed):
    r = parsed["corporates_A_1.xlsm"]
    p = json.loads(r.parsed_payload)
    meta = p["evaluations_metadata"]
    assert meta["Rated entity"] == "Company A"
    assert meta["CorporateSector"] == "Personal & Household Goods"
    assert meta["Country of origin"] == "Federal Republic of Germany"
    assert meta["Accounting principles"] == "IFRS"
    assert meta["End of business year"] == "December"
    assert "General Corporate Rating Methodology" in meta["Rating methodologies applied"]
    assert "Consumer Products Rating Methodology" in meta["Rating methodologies applied"]
    assert meta["Industry risk"] == ["Consumer Products: Non-Discretionary"]
    assert meta["Industry risk score"] == ["A"]
    assert float(meta["Industry weight"][0]) == 1.0
    assert meta["Business risk profile"] == "B+"
    assert meta["Financial risk profile"] == "C"
    assert meta["Liquidity"] == "-2 notches"
    m = p["credit_metrics"]
    years = m["[Scope Credit Metrics]"]
    assert years == ["2024", "2025E"]  # 'Locked' in column M is not part of the list
    ebitda = m["Scope-adjusted EBITDA interest cover"]
    assert float(ebitda[years.index("2024")]) == pytest.approx(36.8)
    assert float(ebitda[years.index("2025E")]) == pytest.approx(36.8)
    assert m["Scope-adjusted FFO/debt"] == ["1.5", "0.00001"]  # positional, exact text
    assert isinstance(m["Liquidity"], list) and len(m["Liquidity"]) == len(years)
    assert r.data_quality_passed and r.errors == []
    assert len(p["_meta"]["schema_sha"]) == 64 and len(p["_meta"]["parser_sha"]) == 64
    assert p["_meta"]["filename"] == "corporates_A_1.xlsm"


def test_company_b_weights(parsed):
    meta = json.loads(parsed["corporates_B_1.xlsm"].parsed_payload)["evaluations_metadata"]
    assert meta["Rated entity"] == "Company B"
    assert meta["CorporateSector"] == "Automobiles & Parts"
    i = meta["Industry risk"].index("Automotive Suppliers")
    assert float(meta["Industry weight"][i]) == 0.15 and meta["Industry risk score"][i] == "BBB"
    j = meta["Industry risk"].index("Automotive and Commercial Vehicle Manufacturers")
    assert float(meta["Industry weight"][j]) == 0.85 and meta["Industry risk score"][j] == "BB"
    assert parsed["corporates_B_1.xlsm"].data_quality_passed


def test_noise_cell_fails_but_row_is_kept(parsed):
    r = parsed["bad.xlsm"]
    assert r.parsed_payload is not None and not r.data_quality_passed
    assert r.errors == ["Unexpected data point found in cell Z100: 'unexpected_noise'"]
    assert json.loads(r.parsed_payload)["unexpected_cells"] == {"Z100": "unexpected_noise"}


def test_two_stray_cells(parsed):
    errs = parsed["stray.xlsm"].errors
    assert len(errs) == 2
    assert "Unexpected data point found in cell Z100: 'stray comment'" in errs
    assert "Unexpected data point found in cell A5: 'unexpected header'" in errs


def test_missing_required_field(parsed):
    errs = parsed["missing.xlsm"].errors
    assert errs == ["Missing required field: 'Rated entity' in section 'evaluations_metadata'"]


def test_missing_sheet(parsed):
    r = parsed["nosheet.xlsm"]
    assert r.status == "invalid_sheet" and r.parsed_payload is None
    assert r.errors == ["Invalid spreadsheet: 'MASTER' sheet not found."]


def test_ignored_text_only_in_its_range(parsed):
    # 'Locked' outside M35:M41 on a label row of the metadata section is expected
    # (row label known), so the file still passes; M35:M41 never reports
    assert parsed["locked_elsewhere.xlsm"].data_quality_passed


def test_list_keeps_interior_nulls_and_trims_trailing(spark):
    book = company_a(extra=[(24, 5, "string", "Second industry")])
    r = _parse(spark, {"f.xlsm": book})["f.xlsm"]
    risk = json.loads(r.parsed_payload)["evaluations_metadata"]["Industry risk"]
    assert risk == ["Consumer Products: Non-Discretionary", None, "Second industry"]


def test_decode_value_rules():
    b = encode_workbook({"MASTER": [(1, 1, "bool", "true"), (1, 2, "date", "2024-01-31"),
                                    (1, 3, "number", "2024"), (1, 4, "number", "1e-05"),
                                    (1, 5, "string", "  padded  ")]})
    recs = {r[3]: r for r in decode_workbook(b) if r[3]}
    assert recs["A1"][4:] == ("bool", "true", "True")
    assert recs["B1"][4:] == ("date", "2024-01-31", "2024-01-31 00:00:00")
    assert recs["C1"][4:] == ("number", "2024", "2024")
    assert recs["D1"][4:] == ("number", "0.00001", "1e-05")
    assert recs["E1"][5] == "  padded  "  # stripped later, in the extraction


def test_cells_with_one_reference(spark):
    """Two cells with one reference stop nothing: in a workbook the last one
    counts, in a cell table the greatest value."""
    book = company_a(extra=[(24, 3, "string", "Yak"), (24, 3, "string", "Zebra"), (100, 26, "string", "x"), (100, 26, "string", "y")])
    r = _parse(spark, {"f.xlsm": book})["f.xlsm"]
    payload = json.loads(r.parsed_payload)
    assert payload["evaluations_metadata"]["Industry risk"] == ["Zebra"]
    assert payload["unexpected_cells"] == {"Z100": "y"} and len(r.errors) == 1
    cells = read_cells(spark.createDataFrame([("h", "f.xlsm", bytearray(encode_workbook(company_a())))], "file_hash string, filename string, content binary"))
    twice = cells.unionByName(cells.filter("row = 24 AND col = 3").withColumns({"value": F.lit("Zinc"), "display": F.lit("Zinc")}))
    x = Extraction(twice)
    got = json.loads(x.payloads().first().parsed_payload)["evaluations_metadata"]["Industry risk"]
    assert got == ["Zinc"] == x.named_lists().filter("label = 'Industry risk'").first()["values"]


def test_payloads_shuffle_twice(spark):
    cells = read_cells(spark.createDataFrame([("h", "f.xlsm", bytearray(encode_workbook(company_a())))], "file_hash string, filename string, content binary"))
    plan = Extraction(cells).payloads()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan


def _book(body: str, styles: str = "") -> bytes:
    """A workbook whose sheet holds the rows ``body``."""
    import io
    import zipfile
    src, out = zipfile.ZipFile(io.BytesIO(encode_workbook({"MASTER": []}))), io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for n in src.namelist():
            data = src.read(n).decode()
            if n.endswith("sheet1.xml"):
                data = data.replace("<sheetData></sheetData>", f"<sheetData>{body}</sheetData><mergeCells><mergeCell ref='A1:B1'/></mergeCells>")
            if styles and n.endswith("styles.xml"):
                data = data.replace("<cellXfs", styles + "<cellXfs", 1).replace("</cellXfs>", "".join(f'<xf numFmtId="{200 + i}"/>' for i in range(6)) + "</cellXfs>")
            z.writestr(n, data)
    return out.getvalue()


def test_times_and_durations():
    """A number below one day in a date format is a time, elapsed formats are
    durations; what no calendar holds is an error text, not a broken file."""
    formats = ["h:mm", "[h]:mm", "[$-409]d-mmm", "[Red]0.0", '"day"0', "[ss].0"]
    styles = "<numFmts>" + "".join(f'<numFmt numFmtId="{200 + i}" formatCode="{f.replace(chr(34), "&quot;")}"/>' for i, f in enumerate(formats)) + "</numFmts>"
    cells = [(2, "0.604166666666667"), (1, "0"), (3, "1.08333333333333"), (4, "0.5"), (5, "2.5"), (6, "45322"), (7, "45322.5"), (8, "3"), (9, "0.001"),
             (1, "45322.75"), (1, "1"), (1, "-700000"), (1, "99999999")]
    body = "<row>" + "".join(f'<c s="{s}"><v>{v}</v></c>' for s, v in cells)
    body += '<c t="d"><v>2024-02-29T10:00:00Z</v></c><c t="d"><v>09:30:00</v></c></row>'
    got = [r[4:] for r in decode_workbook(_book(body, styles)) if r[3]]
    one = lambda s: ("string", s, s)
    assert got == [one("14:30:00"), one("00:00:00"), one("1 day, 2:00:00"), one("12:00:00"), one("2 days, 12:00:00"),
                   ("date", "2024-01-31", "2024-01-31 00:00:00"), ("number", "45322.5", "45322.5"), ("number", "3", "3"), one("0:01:26.400000"),
                   ("date", "2024-01-31", "2024-01-31 18:00:00"), ("date", "1900-01-01", "1900-01-01 00:00:00"), one("#VALUE!"), one("#VALUE!"),
                   ("date", "2024-02-29", "2024-02-29 10:00:00"), one("09:30:00")]


def test_huge_sheet_in_bounded_memory():
    """A sheet of 200,000 cells is never held whole; out of order with
    repeated references it gives the same cells, the last of each."""
    import tracemalloc
    import pandas as pd
    from tessera.sources import workbook
    n = 20_000
    rows = [f'<row r="{r}">' + "".join(f'<c r="{c}{r}"><v>{r}</v></c>' for c in "ABCDEFGHIJ") + "</row>" for r in range(1, n + 1)]
    mixed = [f'<row r="7"><c r="A7"><v>-1</v></c><c r="K7"><v>5</v></c></row>'] + rows[::-1] + ['<row r="9"><c r="B9"><v>-2</v></c><c r="A9"/></row>']
    old, workbook.CELLS_AT_ONCE = workbook.CELLS_AT_ONCE, 5_000
    try:
        for body, first, total in ((rows, {}, 10 * n), (mixed, {"K7": "5", "B9": "-2", "A9": None}, 10 * n + 1 - 1)):
            pdf = pd.DataFrame({"file_hash": ["h"], "filename": ["f"], "content": [_book("".join(body))]})
            seen = {}
            tracemalloc.start()
            for frame in workbook._decode_batches([pdf]):
                assert len(frame) <= 5_000
                if body is mixed:
                    seen.update(zip(frame["coord"], frame["value"]))
                else:
                    seen[None] = seen.get(None, 0) + len(frame)
            peak = tracemalloc.get_traced_memory()[1]
            tracemalloc.stop()
            if body is rows:
                assert seen[None] == total + 1 and peak < 30e6
            else:
                seen.pop(None)
                assert len(seen) == total and all(seen.get(k) == v for k, v in first.items()) and seen["A7"] == "7"
    finally:
        workbook.CELLS_AT_ONCE = old


def test_unreadable_end_of_a_large_workbook(spark):
    """A file that breaks after its first cells leaves one error and no cell."""
    import pandas as pd
    from tessera.sources import workbook
    old, workbook.CELLS_AT_ONCE = workbook.CELLS_AT_ONCE, 100
    try:
        body = "".join(f'<row r="{r}"><c r="A{r}"><v>{r}</v></c></row>' for r in range(1, 500)) + '<row r="500"><c r="A500"><v>x</v></c></row>'
        good = "".join(f'<row r="{r}"><c r="A{r}"><v>{r}</v></c></row>' for r in range(1, 300))
        pdf = pd.DataFrame({"file_hash": ["h", "g"], "filename": ["f", "g"], "content": [_book(body), _book(good)]})
        out = pd.concat(workbook._decode_batches([pdf]))
    finally:
        workbook.CELLS_AT_ONCE = old
    assert list(out[out.filename == "f"]["value_type"]) == ["unreadable"]
    assert list(out[out.filename == "g"]["value"])[1:] == [str(r) for r in range(1, 300)]


def test_named_row_labels_need_no_window(spark):
    """Cells that come with their rows' labels are not shuffled to find them,
    and give what the window gives."""
    from tessera.sources.fixture_cells import cell_grid
    from conftest import SF_SMALL
    grid = cell_grid(spark, SF_SMALL, labels=True)
    lazy = Extraction(grid, materialize=False)
    assert "Window" not in lazy.unexpected()._jdf.queryExecution().executedPlan().toString()
    bare = Extraction(grid.drop("row_label", "row_label_any"), materialize=False)
    cols = ["_f1", "_f2", "row", "col", "value_type", "value", "row_label", "row_label_any"]
    assert lazy.cells.select(cols).exceptAll(bare.cells.select(cols)).isEmpty()


def test_key_values_and_missing_share_one_shuffle(spark):
    cells = read_cells(spark.createDataFrame([("h", "f.xlsm", bytearray(encode_workbook(company_a(drop=("Rated entity",)))))],
                                             "file_hash string, filename string, content binary"))
    x = Extraction(cells)
    kv = x.key_values()
    assert kv._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert not kv.storageLevel.useDisk
    assert [(r.section, r.label) for r in x.required_missing().collect()] == [("evaluations_metadata", "Rated entity")]


def test_many_small_workbooks_share_a_batch(spark):
    """Files are encoded from a stream of cells, not group by group; a file
    without a name is one of them."""
    from tessera.sources.workbook import write_workbooks
    cells = spark.createDataFrame([(h, n, "MASTER", r, 1, "number", str(r)) for h, n in (("a", "a.x"), ("b", "b.x"), (None, None)) for r in (2, 1)]
                                  + [("c", "c.x", "MASTER", None, None, "sheet", None)],
                                  "file_hash string, filename string, sheet string, row int, col int, value_type string, value string")
    books = write_workbooks(cells)
    assert "FlatMapGroupsInPandas" not in books._jdf.queryExecution().executedPlan().toString()
    got = {r.file_hash: [(x[1], x[5]) for x in decode_workbook(bytes(r.content))] for r in books.collect()}
    assert got == {h: [(None, None), (1, "1"), (2, "2")] for h in ("a", "b", None)} | {"c": [(None, None)]}


def test_named_results_take_one_scan_and_one_shuffle(spark):
    """Named values, lists and missing fields are those of the separate
    results, without a table of cells, a join or a second shuffle."""
    from tessera.sources.fixture_cells import cell_grid
    from conftest import SF_SMALL
    x = Extraction(cell_grid(spark, SF_SMALL, labels=True))
    row = lambda r: tuple(tuple(v) if isinstance(v, list) else v for v in r)
    for one, two in ((x.named_key_values(), x.key_values()), (x.named_named_lists(), x.named_lists()),
                     (x.named_required_missing(), x.required_missing().drop("s_idx", "l_idx"))):
        assert sorted(map(repr, map(row, one.collect()))) == sorted(map(repr, map(row, x.named(two).collect())))
    rows = spark.createDataFrame([("h", n, x.t["sheet_name"], r, c, v, t, None if r == 0 else t, None if r == 0 else "Rated entity", None if r == 0 else "Rated entity")
                                  for n in ("a", "b") for r, c, v, t in ((0, 0, "sheet", None), (3, 2, "string", "Rated entity"), (3, 3, "string", "E"))],
                                 "file_hash string, filename string, sheet string, row int, col int, value_type string, value string, display string, row_label string, row_label_any string")
    named = Extraction(rows, materialize=False).named_key_values()
    plan = named._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    assert sorted((r.filename, r.label, r.value) for r in named.collect()) == [("a", "Rated entity", "E"), ("b", "Rated entity", "E")]


def test_files_are_gathered_before_the_shuffle(spark):
    """A task's cells of a file leave it as one row, statements are judged
    without lambdas over an array per cell, and errors alone gather no label's
    texts."""
    from tessera.plans.reports import error_kinds_of
    rows = [("h", "f.xlsm", "MASTER", 0, 0, "sheet", None)] + [("h", "f.xlsm", "MASTER", r, c, "string", v) for r, c, v in (
        (3, 2, "Rated entity"), (3, 3, " A "), (5, 2, "Rated entity"), (24, 2, "Industry risk"), (24, 3, "x"), (24, 5, "y"), (25, 2, "Industry risk"), (25, 4, "z"),
        (50, 1, "s"), (None, 30, "q"))]
    cells = spark.createDataFrame(rows, "file_hash string, filename string, sheet string, row int, col int, value_type string, value string").withColumn("display", F.col("value"))
    label = F.when(F.col("row").isin(3, 5), "Rated entity").when(F.col("row").isin(24, 25), "Industry risk")
    x = Extraction(cells.withColumns({"row_label": label, "row_label_any": label}), materialize=False)
    r = x.payloads().first()
    assert r.parsed_payload.startswith('{"evaluations_metadata":{"Rated entity":null,"Industry risk":[null,"z"]},"credit_metrics":{},"unexpected_cells":{null:null,"A50":"s"},')
    assert r.errors[:2] == [None, "Unexpected data point found in cell A50: 's'"] and len(r.errors) == 21
    plan = x.payloads()._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange hashpartitioning"):]
    assert "partial_collect_list" in below and "lambda" not in below
    kinds = error_kinds_of(x.payloads(), "errors")._jdf.queryExecution().executedPlan().toString()
    assert kinds.count("partial_collect_list") == 1  # unexpected cells


def test_workbook_bytes_are_those_of_the_zip_module():
    """Written members equal the zip module's, byte for byte; members read
    without it are equal too, and broken files give its errors."""
    import io
    import random
    import zipfile
    import pytest
    from tessera.sources import workbook
    content = encode_workbook(company_a())
    assert encode_workbook({"A": [], "B & C": [(1, 28, "string", "é <x>")]}) != content
    src, out = zipfile.ZipFile(io.BytesIO(content)), io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for n in src.namelist():
            info = zipfile.ZipInfo(n, date_time=(1980, 1, 1, 0, 0, 0))
            info.compress_type = zipfile.ZIP_DEFLATED
            z.writestr(info, src.read(n))
    assert out.getvalue() == content
    plain = workbook._Zip(content)
    assert all(plain.read(n) == src.read(n) and plain.size(n) == src.getinfo(n).file_size and n in plain for n in src.namelist())
    assert plain._module is None and "xl/sharedStrings.xml" not in plain
    with pytest.raises(KeyError):
        plain.read("none")
    rnd = random.Random(1)

    def all_of(read):
        try:
            return read()
        except Exception as e:  # noqa: BLE001
            return type(e).__name__
    for _ in range(300):
        bad = bytearray(content)
        bad[rnd.randrange(len(bad))] = rnd.randrange(256)
        bad = bytes(bad[:rnd.choice([len(bad), len(bad), rnd.randrange(len(bad))])])
        for n in src.namelist():
            assert all_of(lambda: workbook._Zip(bad).read(n)) == all_of(lambda: zipfile.ZipFile(io.BytesIO(bad)).read(n))


def test_small_sheet_reads_like_a_large_one(monkeypatch):
    from tessera.sources import workbook
    body = '<row><c><v>1</v></c><c r="D1"><v>2</v></c><c t="inlineStr"><is><r><t>a</t></r><t>b</t></is></c></row><row r="5"><c t="b"><v>1</v></c></row><row/><row><c r="b9"/><c r="A2"><v>3</v></c></row>'
    small = list(decode_workbook(_book(body)))
    monkeypatch.setattr(workbook, "SMALL_SHEET", 0)
    assert small == list(decode_workbook(_book(body))) and [r[3] for r in small] == [None, "A1", "D1", "E1", "A5", "A2"]
