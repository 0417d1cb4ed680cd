"""Licences that are wrapped, stand inside longer texts, or inside a line; and the SQL of the scan."""

import random
import textwrap

import duckdb
import pytest

from nightloom.llm import license_scan
from nightloom.llm.queries import ORACLE_SQL, QUERIES

from .test_stages import prose


def found(spark, texts):
    rows = license_scan.scan_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    out = {}
    for r in rows:
        out.setdefault(r.doc_id, set()).add(r.license_id)
    return [out.get(i, set()) for i in range(len(texts))]


def test_every_template_is_found_wherever_it_stands(spark):
    rng = random.Random(1)
    texts, want = [], []
    for name, notices in license_scan.TEMPLATES.items():
        for notice in notices:
            if not notice.endswith((".", "/", "org")):
                continue  # the beginning of a sentence, which ends nowhere inside a longer one
            before, after = prose(rng, 60) + ".", prose(rng, 60)
            for made in (notice, f"{before}\n{textwrap.fill(notice, 70)}\n{after}", f"{before} {notice} {after.capitalize()}", f"{before}\n\n{textwrap.fill(notice, 40)}\n\n{after}", notice.upper()):
                texts.append(made)
                want.append((name, notice))
    got = found(spark, texts)
    # versions of one notice are told apart by a few words only, and the BSD licences by a clause
    alike = {"BSD-2-Clause": {"BSD-3-Clause"}, "BSD-3-Clause": {"BSD-2-Clause"}}
    missed = [(w, t) for w, t, g in zip(want, texts, got, strict=True) if w[0] not in g and not g & alike.get(w[0], set())]
    assert not missed, missed[:2]


def test_paragraphs_of_a_body(spark):
    body = license_scan.TEMPLATES["MIT"][-1]
    cut = body.index("The above copyright notice"), body.index("THE SOFTWARE IS")
    text = "MIT License\n\nCopyright (c) 2020 Someone\n\n" + "\n\n".join(textwrap.fill(x, 72) for x in (body[: cut[0]], body[cut[0] : cut[1]], body[cut[1] :]))
    assert found(spark, [text, "code before it\n" * 50 + text + "\ncode after it" * 50]) == [{"MIT"}] * 2


def test_clean_texts(spark):
    rng = random.Random(2)
    assert found(spark, [prose(rng, 300), None, "", "licensed under nothing at all, and free to read", "you can redistribute this letter among your friends"]) == [set()] * 5


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    df = QUERIES["op8_license_scan"](spark, sf)
    want = con.execute(ORACLE_SQL["op8_license_scan"]).fetchdf()
    key = lambda rows: sorted((r["doc_id"], r["license_id"], round(r["dice"], 9), r["n_units"], r["first_line"]) for r in rows)
    assert key(r.asDict() for r in df.collect()) == key(want.to_dict("records"))
