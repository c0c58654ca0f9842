"""The licence scan's frequencies at several corpus sizes, licence files and wrapped headers."""

import pytest
from pyspark.sql import functions as F

from surveyprep.llm import license_scan

FULL = {name: text for name, text in license_scan.TEMPLATES if len(text) > 900}
LINE = "released under the mit license, see below"
HEADER = """# Copyright 2020 Some Person
#
# Licensed under the Apache License, Version 2.0 (the "License"); you may
# not use this file except in compliance with the License. You may obtain a
# copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
# WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the
# License for the specific language governing permissions and limitations
# under the License.
"""


def judged(spark, files, filler):
    df = spark.createDataFrame([(k, f"{k}/x", t) for k, t in files.items()], "doc_id string, path string, text string")
    more = spark.range(filler).select(F.concat(F.lit("z"), "id").alias("doc_id"), F.lit("z/z").alias("path"),
                                      F.concat(F.lit("we can see it below the table and of number"), F.lit(" w"), "id").alias("text"))
    return {r.doc_id: r for r in license_scan.licences(df.unionByName(more), "doc_id", "path", "text").where("path <> 'z/z'").collect()}


@pytest.mark.parametrize("filler", [300, 30_000])
def test_common_words_weigh_little(spark, filler):
    """'see' and 'below' are in nearly all lines; with the weight of unseen words, they outweigh the notice as the corpus grows."""
    got = judged(spark, {"a": LINE}, filler)["a"]
    assert got.own_licence == "MIT" and got.score > 0.9


def test_licence_files_and_headers(spark):
    code = "\n".join(f"value{i} = compute{i}(argument{i}, other{i}) plus something{i}" for i in range(60))
    files = {name: f"Copyright (c) 2021 Someone Else\n\n{text}" for name, text in FULL.items()}
    got = judged(spark, files | {"code": HEADER + code, "plain": code}, 3000)
    for name in FULL:
        assert (got[name].own_licence, got[name].is_licence_file) == (name, True)
    assert (got["code"].own_licence, got["code"].is_licence_file) == ("Apache-2.0", False) and got["code"].score > 0.8
    assert got["plain"].own_licence is None
