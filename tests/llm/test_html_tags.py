"""Tags are read whole, whatever their size."""

from __future__ import annotations

import time

from cueflow.llm import html_text as h


def test_large_values_and_many_attributes():
    props = '{"a": "<div>no</div> > "}'.replace('"', "'") * 2000
    for attrs in (f'data-props="{props}"', " ".join(f'a{i}="x > y"' for i in range(1500))):
        assert h.extract(f"<body><article><p {attrs}>kept text</p></article></body>") == "kept text"


def test_never_closed_values_take_linear_time():
    began = time.time()
    for page in ('<a x="' * 50_001, "<a x='\">" * 50_000, "<!" * 50_000, "<a =" * 50_000):
        h.blocks(page)
    assert time.time() - began < 20
    assert h.extract('<body><p class="x>one</p><p>two</p></body>') == "one\n\ntwo"
