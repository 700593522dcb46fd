"""Each license rule finds a mention of its own, also through the keyword gate."""

import re

from incidentlake.llm import license_scan
from incidentlake.llm.license_scan import RULES

IDS = """MIT ISC MPL-2.0 LGPL-3.0 LGPL-2.1 AGPL-3.0 EPL-2.0 BSL-1.0 Zlib 0BSD Artistic-2.0 OFL-1.1 Apache-2.0 BSD-2-Clause BSD-3-Clause
GPL-2.0 GPL-3.0 CC0-1.0 Unlicense WTFPL PostgreSQL NCSA MS-PL CDDL-1.0 EUPL-1.2 MIT-0""".split()


def example(pattern):
    """A string the pattern matches: options left out, first alternatives."""
    last = None
    while last != pattern:
        last, pattern = pattern, re.sub(r"\(\?[:=]([^()|]*)(?:\|[^()]*)?\)(\??)", lambda m: "" if m[2] else m[1], pattern)
    pattern = re.sub(r"\[0-9\]\{2\}", "21", pattern)
    return re.sub(r"\[(.)[^\]]*\]", r"\1", pattern)


def labels(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    return {r.doc_id: list(r.labels) for r in license_scan.scan_licenses(docs).collect()}


def test_every_rule_matches_its_example(spark):
    got = labels(spark, ["on\n" + example(r.pattern).replace(" ", "\n") + "\nand" for r in RULES])
    assert [(r.pattern, got[k]) for k, r in enumerate(RULES) if r.label not in got[k]] == []


def test_spdx_ids(spark):
    got = labels(spark, [f"# SPDX-License-Identifier: {x}\n" for x in IDS])
    assert [got[k] for k in range(len(IDS))] == [[x.lower()] for x in IDS]


def test_short_names(spark):
    cases = {
        "licensed under the GPL": "gpl", "released under the LGPL.": "lgpl", "available under AGPL": "agpl", "distributed under MIT": "mit", "uses MPL 2.0": "mpl-2.0",
        "SPDX-License-Identifier: GPL-2.0-or-later": "gpl-2.0", "published under the ISC": "isc",
    }
    got = labels(spark, [*cases, "the mit and gpl of it, mitre", ""])
    assert [got[k] for k in range(len(cases) + 2)] == [*([x] for x in cases.values()), [], []]


def test_gate_lets_wrapped_and_hyphenated_words_pass(spark):
    cases = {"public\ndomain": "public-domain", "public-domain": "public-domain", "released into the public\ndomain": "public-domain", "MIT No Attribution": "mit-0"}
    got = labels(spark, list(cases))
    assert [got[k] for k in range(len(cases))] == [[x] for x in cases.values()]
