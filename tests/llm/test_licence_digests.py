from seqloom.llm import licence_digests as L
from tests.llm.conftest import EDGE_ROWS, make_docs


def test_entire_texts_and_lines(spark):
    mit, body = [t for n, t in L.whole_texts() if n == "MIT"]
    rows = [
        (1, body, "en", "s"),
        (2, "MIT Licence\n\nCopyright (c) 2020 Someone, all rights\n\n" + body.upper().replace(",", " , ").replace(" ", "  "), "en", "s"),
        (3, body + " And one more.", "en", "s"),
        (4, "Some text.\n  Released under the MIT licence!\nMore.\nLicensed under CC BY-NC 4.0", "en", "s"),
        (5, "It says: Released under the MIT License. So there.", "en", "s"),
        (6, body.replace("NONINFRINGEMENT", "non-infringement").replace("sublicense", "sub-licence"), "en", "s"),
        (7, "© 1999 A\ncopyright B", "en", "s"),
        (8, mit, "en", "s"),
    ]
    got = {r["doc_id"]: (r["licence"], r["notices"]) for r in L.scan(make_docs(spark, rows)).collect()}
    assert {d: x[0] for d, x in got.items()} == {1: "MIT", 2: "MIT", 3: None, 4: None, 5: None, 6: "MIT", 7: None, 8: "MIT"}
    assert got[4][1] == "CC-BY-NC-4.0|MIT" and got[5][1] is None


def test_edge_rows(spark, edge_docs, no_docs):
    got = L.scan(edge_docs)
    assert got.count() == len(EDGE_ROWS)
    empty = {r["digest"] for r in got.filter("doc_id in (1, 2, 3)").collect()}
    assert empty == {"d41d8cd98f00b204e9800998ecf8427e"}
    assert got.filter("licence is not null or notices is not null").count() == 0
    assert L.scan(no_docs).count() == 0


def test_whole_licences_and_notices_by_rule(spark):
    texts = dict(L.whole_texts()[::2])
    assert len(texts) >= 12
    rows = [(i, "Copyright (c) 2021, Some One\nAll rights reserved.\n\n" + t.upper().replace("LICENSE", "LICENCE"), "en", "s") for i, t in enumerate(texts.values())]
    rows += [(100, "Licensed under the GPL, version 3", "en", "s"), (101, "x\nThis work is licensed under the Apache License, Version 2.0.\ny", "en", "s"), (102, "Released under CC BY-NC 4.0.", "en", "s")]
    rows += [(None, "a\nReleased under the MIT License.", "en", "s"), (None, "nothing here at all", "en", "s"), (7, "Licensed under ISC", "en", "s")]
    got = L.scan(make_docs(spark, rows)).collect()
    by_id = {r["doc_id"]: r for r in got if (r["doc_id"], r["notices"]) != (7, "ISC")}
    assert [by_id[i]["licence"] for i in range(len(texts))] == list(texts)
    assert [by_id[i]["notices"] for i in (100, 101, 102)] == ["GPL-3.0", "Apache-2.0", "CC-BY-NC-4.0"]
    assert sorted(str(r["notices"]) for r in got if r["doc_id"] is None) == ["MIT", "None"]  # nameless rows share nothing
