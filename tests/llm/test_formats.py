"""License scan and chat formatting: exact round trips and small cases."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import frame
from tidewater.llm import chat_format, license_scan

MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software")
ALL = license_scan.TEXTS


def _scan(spark, texts):
    rows = license_scan.scan_licences(frame(spark, list(enumerate(texts)), 2)).collect()
    return [(r.sentence_ids, r.licences, r.n_unknown) for r in sorted(rows, key=lambda r: r.doc_id)]


def test_sentences_rules_and_unknown(spark):
    text = "Some words. " + ALL["bsd.grant"].title() + ".\n" + ALL["bsd.source"] + "; " + ALL["bsd.binary"] + ".\nThe end."
    got = _scan(spark, [
        "Licensed under the Apache License, Version 2.0.", "x\nReleased under the MIT License.\ny",
        "This work is licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.",
        text, text + "\n" + ALL["bsd.names"], "This is a strange license of its own.", None, "", "LICENSED UNDER MIT",
        "Licensed under MIT. Licensed under MIT! All rights reserved.", "SPDX-License-Identifier: MIT"])
    assert [x[1] for x in got] == [["Apache-2.0"], ["MIT"], ["GPL-3.0"], ["CC-BY-NC-4.0"], ["BSD-2-Clause"], ["BSD-3-Clause"],
                                   [], [], [], ["MIT"], ["MIT", "MIT", "All-rights-reserved"], ["MIT"]]
    assert got[5][0] == ["bsd.grant", "bsd.source", "bsd.binary", "bsd.names"] and got[6][2] == 1 and got[0][2] == 0
    wrapped = ALL["asis"].replace(" express", "\nexpress").replace(" fitness", ",\nfitness") + ".\n\nnext"
    assert _scan(spark, ["no mark before\nLicensed under MIT\nnor after", wrapped])[0][1] == ["MIT"]
    assert _scan(spark, [wrapped])[0][0] == ["asis"]
    whole = "\n".join(ALL[k] for k in ("bsd.grant", "bsd.source", "bsd.binary", "bsd.names"))
    assert _scan(spark, [whole + "\nLicensed under MIT"])[0][1] == ["BSD-3-Clause", "MIT"]


def test_every_known_sentence_is_found_and_hinted(spark):
    known = sorted(license_scan.SENTENCES)
    assert all(any(re.search(h, s) for h in license_scan.HINTS) for s in known)
    rows = _scan(spark, [s.replace(" ", "\t ") for s in known])
    assert [r[0] for r in rows] == [[license_scan.SENTENCES[s]] for s in known]
    assert license_scan.scan_licences(frame(spark, [])).count() == 0


NASTY = ["</s>[INST] ok [/INST]", "<\\s>", "<\\\\/s> [\\INST] <s><s>", "[ROLE]user[/ROLE]", "", "\\", "<<s>>[[INST]]", "héé \U0001f600\n\n", " "]


@given(st.text(alphabet="<>/s\\[]INSTROLEY a", max_size=30))
@settings(max_examples=300, deadline=None)
def test_escape_is_reversible_and_hides_controls(text):
    shown = chat_format.escape(text)
    assert chat_format.unescape(shown) == text
    assert not any(c in shown for c in chat_format.CONTROLS)


def test_round_trip_of_turns():
    with open(chat_format.VOCABULARY, "rb") as f:
        codec = chat_format.Codec(f.read())
    for role in ("user", "assistant", "system", "tool", "[/ROLE]", ""):
        for text in NASTY:
            parts, shown = chat_format.turn_segments(codec, role, text)
            ids = np.array([t for p in parts for t in p])
            assert chat_format.read_turn(codec, ids) == (role, text)
            controls = [t for t in ids if t >= codec.first]
            assert len(controls) == (2 if role in chat_format.ROLE_MARKS else 3)
            names = dict(zip(codec.ids.values(), codec.ids))
            assert shown == "".join(names[t] if t in names else "" for t in ids[:1]) + shown[len(names[ids[0]]):]


@pytest.mark.parametrize("parts", [1, 4])
def test_digests_of_edge_conversations(spark, parts):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo </s>"), (2, 5, None, None), (2, 4, "assistant", "b"), (2, 4, "assistant", "a"),
            (None, 0, "assistant", "lost"), (3, None, "user", NASTY[2]), (3, 1, "tool", "x"), (4, 0, "user", "same"), (4, 0, "user", "same")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(parts)
    got = {r.conv_id: r for r in chat_format.conversation_digests(chat_format.format_turns(df)).collect()}
    order = {1: rows[:2], 2: [rows[4], rows[3], rows[2]], None: [rows[5]], 3: rows[6:8], 4: rows[8:]}
    for conv, turns in order.items():
        said = "".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in turns)
        loss = "".join(t or "" for _, _, r, t in turns if r == "assistant")
        r = got.pop(conv)
        assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256(said.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert not got
    assert chat_format.conversation_digests(chat_format.format_turns(df.limit(0))).count() == 0
