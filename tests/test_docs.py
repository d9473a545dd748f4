"""The README's operator inventory names exactly the registered queries."""

import os
import re

from cohortkit.plans.registry import oracle_sql, queries

README = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "README.md")


def _inventory_keys() -> set[str]:
    text = open(README, encoding="utf-8").read()
    section = text[text.index("## Operator inventory"):text.index("## Plan design for scale")]
    keys = set()
    for line in section.splitlines():
        if line.startswith("|") and not line.startswith("| ---"):
            cells = [c.strip() for c in line.strip("|").split("|")]
            if len(cells) >= 2:
                keys |= set(re.findall(r"`([a-z0-9_]+)`", cells[1]))
    # the recency rows use brace shorthand: recency_start_{0_90,...}
    for prefix, body in re.findall(r"`(recency_(?:start|end))_\{([^}]*)\}`", section):
        for part in body.split(","):
            if part != "...":
                keys.add(f"{prefix}_{part}")
    return keys


def test_readme_lists_every_registered_key():
    registered = set(queries())
    listed = _inventory_keys()
    expanded = {k for k in registered if k.startswith("recency_end_")}
    assert registered - listed - expanded == set()
    assert listed - registered == set()
    assert set(oracle_sql()) == registered
