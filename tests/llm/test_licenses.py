"""License digests: canonical form and lookup."""

from helpers import by_id, docs_frame, with_odd_columns

from tideframe.llm import licenses

MIT = next(text for name, text in licenses.KNOWN if name == "MIT" and text.startswith("MIT License"))


def test_whole_texts_and_lines(spark):
    disguised = MIT.upper().replace("MIT LICENSE", "MIT LICENCE\n\nCopyright (c) 2020 Some One <a@b.c>\nAll rights reserved.\n").replace(", ", " ,\n  ")
    texts = [
        disguised, MIT, MIT + " changed", "x\nreleased under the mit licence\ny", "Licensed under the Apache License, Version 2.0.",
        "// SPDX-License-Identifier: MIT\n# SPDX-License-Identifier: Apache-2.0\n# spdx license identifier mit", "© 2020 Me", "", None, "Licensed under CC BY-NC 4.0!",
    ]
    docs = with_odd_columns(docs_frame(spark, [*texts, (3, "nothing"), (None, "Licensed under CC BY 4.0.")]), "digest", "license", "whole")
    found = {k: [(r.text_license, r.licenses, r.n_lines) for r in rows] for k, rows in by_id(licenses.scan_licenses(docs)).items()}
    assert found[0] == [("MIT", "", 0)]
    assert found[1] == [("MIT", "MIT", 1)]
    assert found[2] == [(None, "", 0)]
    assert found[3] == [(None, "MIT", 1)] * 2
    assert found[4] == [("Apache-2.0", "Apache-2.0", 1)]
    assert found[5] == [(None, "Apache-2.0,MIT", 3)]
    assert found[6] == found[7] == found[8] == [(None, "", 0)]
    assert found[9] == [("CC-BY-NC-4.0", "CC-BY-NC-4.0", 1)]
    assert found[None] == [("CC-BY-4.0", "CC-BY-4.0", 1)]
    assert licenses.scan_licenses(docs.limit(0)).count() == 0


def test_native_plan(spark):
    assert "Python" not in licenses.scan_licenses(docs_frame(spark, ["x"]))._jdf.queryExecution().executedPlan().toString()
