"""Entities written in several ways inside one text."""

import pytest
from retail_insight.llm import pii


@pytest.mark.parametrize("a,b", [("2001:db8::1", "2001:0db8::1"), ("2001:db8::1", "2001:db8:0:0::1"), ("2001:db8::1", "2001:DB8::1"),
                                 ("2001:db8::a1", "2001:db8::A1"), ("+1 (386) 555-1832", "(386) 555-1832")])
def test_two_spellings_of_one_entity_in_one_text(a, b):
    new, found = pii.replace(f"from {a} to {b} and {a}.", b"k")
    assert len(found) == 3 and a not in new and b not in new


def test_entities_that_share_a_surrogate_get_different_ones(monkeypatch):
    monkeypatch.setattr(pii, "surrogate", lambda kind, text, key: f"<{len(key)}{key[-1:]}>")
    new, _ = pii.replace("from 10.1.2.3 to 10.1.2.4 and 10.1.2.3", b"k")
    first, second, third = new[5:].replace(" to ", "|").replace(" and ", "|").split("|")
    assert first == third != second
