import duckdb

from shelfwise.llm import licenses as li
from shelfwise.llm.queries import ORACLES, QUERIES
from tools.check import compare


def test_spellings_and_copyright_lines(spark):
    other = "# Copyright (c) 2020 Someone\n" + li.MIT.upper().replace("SUBLICENSE", "SUB-LICENCE").replace("\n", "\r\n  ").replace('"', "“")
    rows = [
        (1, other, "x"), (2, "Hello\n released under the MIT  Licence!\nworld", "x"), (3, None, "x"), (4, "", "x"), (5, "…", "x"),
        (6, "intro\n\n" + li.ISC.replace("\n\n", "\n") + "\n\nrest " * 3000, "x"), (None, li.APACHE_HEADER, "x"), (1, other, "x"),
        (7, "Released under the MIT License or not.", "x"),
    ]
    got = li.license_scan(spark.createDataFrame(rows, "doc_id long, text string, license string")).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 9 and by[1].license == "MIT" and by[None].license == "Apache-2.0"
    assert by[2].notices == ["MIT"] and by[2].license is None and by[6].notices == ["ISC"]
    assert all(by[i].digest is None and by[i].n_notices == 0 for i in (3, 4, 5)) and by[7].notices == []


TITLES = {"MIT": "The MIT License (MIT)", "BSD-2-Clause": "BSD 2-Clause License", "BSD-3-Clause": 'BSD 3-Clause "New" or "Revised" License',
          "ISC": "ISC Licence", "Zlib": "zlib License", "Unlicense": "", "Apache-2.0": ""}


def test_whole_texts_with_titles_and_inside_others(spark):
    texts = {name: max((t for n, t in li.KNOWN if n == name), key=len) for name in TITLES}
    rows = []
    for k, (name, title) in enumerate(TITLES.items()):
        head = f"{title}\n\nCopyright (c) 2019-2021, Some One\nAll rights reserved.\n\n"
        narrow = "\n".join(w + " " + " ".join(texts[name].split()[i + 1 : i + 3]) for i, w in enumerate(texts[name].split()) if i % 3 == 0)
        rows += [(4 * k, head + texts[name]), (4 * k + 1, "a book\n" + head + texts[name] + "\n\nits text\n" + texts[name])]
        rows += [(4 * k + 2, "x\n" + narrow + "\ny"), (4 * k + 3, "x\n" + texts[name] + " and more\ny, but " + texts[name])]
    by = {r.doc_id: r for r in li.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, name in enumerate(TITLES):
        assert (by[4 * k].license, by[4 * k].notices) == (name, [name])
        assert (by[4 * k + 1].license, by[4 * k + 1].notices) == (None, [name])
        assert by[4 * k + 2].notices == [name] and by[4 * k + 3].notices == []


def test_folder_of_texts(spark, tmp_path):
    (tmp_path / "Long-1.0").write_text("\n".join(f"Clause {i}: word{i % 7}, word{i % 11}." for i in range(6000)))
    (tmp_path / "Short").write_text("Do\nwhat you like")
    known = li.read_licenses(spark, str(tmp_path))
    long = (tmp_path / "Long-1.0").read_text().replace("\n", " ")
    docs = [(1, f"intro\n{long}\nDo what you like.\n" * 2), (2, long), (3, long + " x"), (4, "do what\n\nyou like!")]
    got = {r.doc_id: (r.license, r.notices) for r in li.license_scan(spark.createDataFrame(docs, "doc_id long, text string"), known).collect()}
    assert got == {1: (None, ["Long-1.0", "Short"]), 2: ("Long-1.0", ["Long-1.0"]), 3: (None, []), 4: ("Short", ["Short"])}


def test_own_list_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "A, b & c")], "doc_id long, text string")
    known = spark.createDataFrame([("Z", "a b and C."), ("Y", "a b and c"), (None, "q"), ("W", None)], "license string, text string")
    assert li.license_scan(docs, known).first().license == "Y"
    none = spark.createDataFrame([], "doc_id long, text string")
    assert li.license_scan(none).count() == 0
    assert li.license_scan(docs, spark.createDataFrame([], "license string, text string")).first().license is None


def test_query_equals_sql(spark, folder):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    found = QUERIES["op3_license_scan"](spark, folder)
    assert compare(found, db, ORACLES["op3_license_scan"]) is None
    assert found.filter("n_notices > 0").count() > 0
