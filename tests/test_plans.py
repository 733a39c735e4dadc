"""Plan checks: no driver-side collection in operators, pruned scans."""

import os
import re

import __spark_entry__ as E
from voxtab.sources.files import scan_files

ROOT = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "voxtab")


def test_no_collect_in_library():
    offenders = []
    for dirpath, dirs, files in os.walk(ROOT):
        dirs[:] = [d for d in dirs if d != "llm"]  # tested in tests/llm
        for f in files:
            if f.endswith(".py"):
                text = open(os.path.join(dirpath, f), encoding="utf-8").read()
                for pat in (r"\.collect\(\)", r"\.toPandas\(\)", r"localCheckpoint", r"crossJoin"):
                    if re.search(pat, text):
                        offenders.append((f, pat))
    assert offenders == []


def test_scan_prunes_content(spark, tmpdir_fresh):
    with open(f"{tmpdir_fresh}/a.wav", "wb") as fh:
        fh.write(b"x" * 100)
    plan = scan_files(spark, tmpdir_fresh)._jdf.queryExecution().executedPlan().toString()
    schema = re.search(r"ReadSchema: (struct<[^>]*>)", plan).group(1)
    assert "content" not in schema and "path" in schema


def test_table_scan_reads_only_used_columns(spark):
    df = E.queries()["h3_canonical_lang"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    schema = re.search(r"ReadSchema: (struct<[^>]*>)", plan).group(1)
    assert schema == "struct<doc_id:bigint,lang:string>"
