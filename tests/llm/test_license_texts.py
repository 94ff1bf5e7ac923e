"""Labels of the further licence notices: whole, within other words, and of texts that only sound like them."""

from __future__ import annotations

import pytest

from eventmart.llm import license_scan
from eventmart.llm.license_texts import NOTICES
from test_llm import documents

INTRO, AFTER = "notes of release seven for everyone who asked about shipping ", " and then the recipe begins with two onions"

CASES = {
    "Permission is hereby granted to walk on the grass free of charge": "",
    "all rights to this work are in the public domain worldwide": "",
    "this library is free software for readers of general interest": "",
    "as published by the Free Software Foundation": "",
    "This program and the accompanying materials are made available under the sofa": "",
    "Distributed under the Boost Software License, Version 1.0.": "bsl-1.0",
    "This is free and unencumbered software released into the public domain.": "unlicense",
}


def test_notices_in_other_words(spark):
    texts = {INTRO + text + AFTER: label for label, text in NOTICES} | CASES
    got = {r.doc_id: r for r in license_scan.license_labels(documents(spark, list(texts))).collect()}
    for k, (text, label) in enumerate(texts.items()):
        base = {v for phrase, v in license_scan.PHRASES.items() if phrase in text.lower()}
        assert set(filter(None, got[k].labels.split(","))) == base | ({label} if label else set()), text


@pytest.mark.parametrize("kind", ["Lesser ", "Affero ", ""])
def test_gnu_licences_are_told_apart(spark, kind):
    text = f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License as published by the Free Software Foundation, either version 3 of the License"
    got = license_scan.license_labels(documents(spark, [text])).first().labels
    assert got == {"Lesser ": "gpl,lgpl", "Affero ": "agpl,gpl", "": "gpl"}[kind]  # the phrase itself is labelled gpl
    spans = license_scan.license_spans(documents(spark, [text])).first().spans
    assert {s.label for s in spans if s.labelled} == {{"Lesser ": "lgpl", "Affero ": "agpl", "": "gpl"}[kind]}
