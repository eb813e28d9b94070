"""Secrets, user data and mailboxes of any length lie inside their spans, in linear time."""

from __future__ import annotations

import time

import pytest

from tidemark.llm import pii


@pytest.mark.parametrize("size", [40, 320, 6000, 300_000])
def test_spans_reach_to_the_end(size):
    secret = ("a1B2-c3.D4_" * size)[:size].rstrip("-._")
    text = f"see token: {secret}, thanks"
    assert pii.spans(text)["account"] == [(11, 11 + len(secret))]
    url = f"https://{'u' * size}:{'p4:' * size}@host.example"
    assert pii.spans(f"at {url} now")["address"] == [(3, 3 + len(url))]
    box = f"mailto:{'m.' * size}x@host.example"
    assert pii.spans(f"at {box} now")["address"] == [(3, 3 + len(box))]


@pytest.mark.parametrize("part", ["token1-", "token: token=", "a://u:", "mailto:a", "x://user", "password=1.", "sip:a@", "secret no ", "account-1/"])
def test_linear_in_odd_texts(part):
    start = time.process_time()
    pii.spans(part * 60_000)
    assert time.process_time() - start < 10
