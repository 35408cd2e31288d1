import re

import pytest
from pyspark.sql import functions as F

from millrace.llm import licenses


@pytest.fixture(scope="module")
def classifier(spark, documents):
    return licenses.Classifier(spark, documents)


def lines(corpus, texts):
    return licenses.paragraphs(corpus(list(enumerate(texts))))


def test_the_bound_is_exact(spark, classifier, documents, corpus):
    """What the words of the list do not let through is unknown, paragraph by paragraph."""
    rows = documents.select("doc_id", "text").limit(300).collect()
    notices = [t for texts in licenses.TEMPLATES.values() for t in texts] + [" ".join(t.split()[::2]) for texts in licenses.TEMPLATES.values() for t in texts]
    frame = corpus([(r.doc_id, r.text) for r in rows] + [(10_000 + i, t) for i, t in enumerate([*notices, *licenses.MISLEADING])])
    key = ["doc_id", "paragraph", "lines"]
    every = classifier.classify(licenses.paragraphs(frame))
    believed = {tuple(r[k] for k in key) for r in every.where("family <> 'unknown'").collect()}
    passed = {tuple(r[k] for k in key) for r in licenses.paragraphs(frame, classifier.telling).collect()}
    assert believed <= passed and len(passed) < every.count() / 2
    assert len(believed) > 80


def test_unseen_notices_get_rows(classifier, corpus):
    texts = {
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY': "mit",
        "Distributed under MPL 2.0": "mpl-2.0",
        "This file is GPLv3": "gpl-3.0",
        "Code is available under Apache 2.0": "apache-2.0",
        "(c) 2020 Some Company": "proprietary",
        "Unless required by applicable law or agreed to in writing, software": "apache-2.0",
        "Alle Rechte vorbehalten": "proprietary",
    }
    rows = classifier.classify(licenses.paragraphs(corpus(list(enumerate(texts))), classifier.telling)).collect()
    assert {r.doc_id: r.family for r in rows} == dict(enumerate(texts.values()))


def test_recall_on_held_out_variants(spark, classifier, documents):
    """Variants drawn with another salt: families found, and other paragraphs left alone."""
    strange = licenses.negatives(documents, licenses.Scan(negatives=400)).withColumn("salt", F.lit("other"))
    rows = licenses.training_rows(spark, strange, licenses.Scan(), "other")
    known = classifier.chances(classifier.labelled(rows)).where("label > 0 OR chance >= 0").collect()
    notices = [r for r in known if r.label > 0]
    right = [r for r in notices if r.chance >= classifier.least and classifier.families[int(r.label)] == r.best]
    wrong = [r for r in known if r.label == 0 and r.chance >= classifier.least]
    assert len(right) > 0.93 * len(notices)
    assert len(wrong) < 0.02 * (len(known) - len(notices))


def test_blocks_of_lines(classifier, corpus):
    text = "Intro\n\nLicensed under the Apache License,\n Version 2.0 (the License); you may not\nuse this file except in compliance\n\n\nx\ny\n  \nz"
    every = {(r.paragraph, r.lines): " ".join(r.words) for r in licenses.paragraphs(corpus([(1, text)])).collect()}
    assert every == {
        (0, 1): "intro", (2, 1): "licensed under the apache license", (3, 1): "version 2 0 the license you may not", (4, 1): "use this file except in compliance",
        (2, 3): "licensed under the apache license version 2 0 the license you may not use this file except in compliance",
        (7, 1): "x", (8, 1): "y", (7, 2): "x y", (10, 1): "z",
    }
    found = classifier.classify(licenses.paragraphs(corpus([(1, text)]), classifier.telling)).where("confirmed").collect()
    assert (2, 3, "apache-2.0") in {(r.paragraph, r.lines, r.family) for r in found}


def test_notices_of_the_given_table(spark, documents):
    notice = {
        "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0",
        "All rights reserved.": "proprietary",
        "Licensed under CC BY-NC 4.0.": "cc-by-nc",
        "Released under the MIT License.": "mit",
        "Licensed under the Apache License, Version 2.0.": "apache-2.0",
    }
    expected = set()
    for r in documents.select("doc_id", "text").collect():
        for i, line in enumerate(r.text.split("\n")):
            if line in notice:
                expected.add((r.doc_id, i, notice[line]))
    rows = licenses.scan_licenses(spark, documents).where("confirmed").collect()
    assert expected and expected <= {(r.doc_id, r.paragraph, r.family) for r in rows}


def test_variants(classifier, corpus):
    texts = {
        "this program is licensed under the apache license version 2.0": "apache-2.0",
        "* Released under the MIT License, see the file for more.": "mit",
        "The text is Licensed under CC BY-SA 4.0 as of today": "cc-by-sa",
        "All Rights Reserved": "proprietary",
    }
    rows = classifier.classify(lines(corpus, list(texts))).collect()
    assert {r.doc_id: (r.family, r.confirmed) for r in rows} == {i: (f, True) for i, f in enumerate(texts.values())}


def test_other_sentences_are_unknown(classifier, corpus):
    texts = ["My driving license is at home with the dog.", "Nobody gave permission to enter the old garden.", "The copyright office was closed on Monday for the feast."]
    rows = classifier.classify(lines(corpus, texts)).collect()
    assert len(rows) == 3 and not any(r.confirmed for r in rows)


def test_odd_rows(spark, corpus, odd_rows):
    rows = [*odd_rows, (50, "All rights reserved.\n\nAll rights reserved."), (None, "Released under the MIT License.")]
    out = licenses.scan_licenses(spark, corpus(rows, extra=["family", "words", "line"])).collect()
    got = sorted(((r.doc_id, r.paragraph, r.family) for r in out if r.confirmed), key=str)
    assert got == sorted([(50, 0, "proprietary"), (50, 2, "proprietary"), (None, 0, "mit")], key=str)
    assert licenses.scan_licenses(spark, corpus([])).count() == 0


def test_no_python_in_the_plan(classifier, documents):
    plan = classifier.classify(licenses.paragraphs(documents))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
