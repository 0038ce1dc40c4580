"""The license scan next to its SQL on notices wrapped over lines, which the given tables do not hold."""

import duckdb

from codetide.llm.queries import ORACLES, QUERIES
from codetide.session import fresh_path

TEXTS = [
    "released under the\nMIT license",
    "released under the\n\nMIT license",
    "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the x), to deal",
    "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided",
    "x released under the MIT license. done",
    "licensed under the\r\nApache License, Version 2.0",
    "cc by and\nall rights\nreserved, no more",
    None,
    "",
]


def test_wrapped_notices(spark):
    folder = fresh_path(spark, "licenses").removeprefix("file://")
    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").coalesce(1).write.parquet(f"{folder}/documents.parquet")
    got = QUERIES["op7_licenses"](spark, folder)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{folder}/documents.parquet/*.parquet'")
    want = con.sql(f"select {', '.join(got.columns)} from ({ORACLES['op7_licenses']})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert {r[0]: r[1] for r in got.select("doc_id", "labels").collect()}[2] == "mit-grant"
