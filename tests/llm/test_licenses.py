import hashlib
import os
import re

import pytest

from tickerloom.llm import licenses as op

COMMON = "/usr/share/common-licenses"
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.
"""


def brute_digest(text):
    if text is None:
        return None
    low = re.sub(r"(^|\n)[ \t*#/;-]*(copyright|\(c\)|©|all rights reserved)[^\n]*", "\n", text.lower())
    words = re.findall(r"[^\W_]+", low)
    same = dict(op.EQUIVALENT)
    joined = " ".join(same.get(w, w) for w in words)
    return hashlib.sha256(joined.encode()).hexdigest() if joined else None


def scanned(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    return [tuple(r)[1:] for r in sorted(op.report(df).collect(), key=lambda r: r["doc_id"])]


def test_whole_texts(spark):
    variants = [
        MIT, f"MIT License\n\nCopyright (c) 2020 A. Person\n\n{MIT}", MIT.upper().replace("SUBLICENSE", "sublicence"),
        f"  * Copyright 1999 X\n  * (c) Y\n{MIT}\n\n\n", MIT.replace("\n", " "), MIT + " or not", "", None, "!!! ...",
    ]
    found = scanned(spark, variants)
    assert [f[1] for f in found] == ["MIT"] * 5 + [None] * 4
    assert [f[0] for f in found] == [brute_digest(t) for t in variants]


def test_neighbouring_spellings(spark):
    texts = ["licence licence LICENCE", "a,licence/licence.whilst", "sublicence relicence", "licence"]
    assert [f[0] for f in scanned(spark, texts)] == [brute_digest(t) for t in texts]


def test_notices(spark):
    texts = [
        "Prose.\nReleased under the MIT License.\nLicenced under CC BY-NC 4.0!",
        "Licensed under the Apache License, Version 2.0.", "I read about the MIT License.",
        "This work is licensed under the GNU General Public License, version 3.\n" * 2,
    ]
    assert [f[2] for f in scanned(spark, texts)] == ["CC-BY-NC-4.0,MIT", "Apache-2.0", "", "GPL-3.0"]


def test_every_form_of_a_notice(spark):
    names = {"CC BY 4.0": "CC-BY-4.0", "CC BY-NC 4.0": "CC-BY-NC-4.0", "CC BY-SA 4.0": "CC-BY-SA-4.0"}
    forms = ("Released under", "DISTRIBUTED UNDER", "released,  under the", "Distributed\tunder the")
    texts = [f"x\n{form} {name}.\ny" for form in forms for name in names]
    assert [f[2] for f in scanned(spark, texts)] == list(names.values()) * len(forms)
    assert len(op.notices()) == len(op.NAMES) * len(op.FORMS) * 2


@pytest.mark.skipif(not os.path.isdir(COMMON), reason="no licence texts here")
def test_known_texts(spark):
    names = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1",
             "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0", "BSD": "BSD-3-Clause"}
    names = {k: v for k, v in names.items() if os.path.exists(f"{COMMON}/{k}")}
    texts = [open(f"{COMMON}/{k}", encoding="utf-8").read() for k in names]
    assert [f[1] for f in scanned(spark, texts)] == list(names.values())


def test_odd_rows(odd, odd_rows, empty, listed, widen):
    expected = sorted(((r[0], brute_digest(r[1])) for r in odd_rows), key=lambda r: [(x is None, x) for x in r])
    assert listed(op.report(odd), "doc_id", "digest") == expected
    assert listed(op.report(widen(odd).withColumnsRenamed({"key": "license"})), "doc_id", "digest") == expected
    assert op.report(empty).count() == 0


def test_main_path_is_native(odd):
    plan = op.report(odd)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan) and "BroadcastHashJoin" in plan
