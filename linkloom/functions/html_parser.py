"""Anchor extraction with Python's ``html.parser`` (``extract="parser"``).

Slow path for markup the native regex cannot read (full named-entity
table, unbalanced quotes).  Runs per Arrow batch in ``mapInPandas``; the
page bodies never leave their partition.
"""

from __future__ import annotations

from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructField, StructType


class _Anchors(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.hrefs: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            for k, v in attrs:
                if k == "href":
                    self.hrefs.append(v if v is not None else "")
                    break


def _anchors(html: str | None) -> list[str]:
    if not html:
        return []
    p = _Anchors()
    p.feed(html)
    p.close()
    return p.hrefs


def parser_links(pages: DataFrame) -> DataFrame:
    """A row for each link of each row of ``pages``: the row's own columns but ``html``, then ``pos, href``."""
    carried = [f for f in pages.schema.fields if f.name != "html"]
    schema = StructType([*carried, StructField("pos", LongType()), StructField("href", StringType())])

    def batches(it):
        for pdf in it:
            found = [_anchors(html) for html in pdf["html"]]
            rows = pdf.drop(columns="html").loc[np.repeat(pdf.index, [len(f) for f in found])]
            yield rows.assign(pos=[i for f in found for i in range(1, len(f) + 1)], href=[h for f in found for h in f])

    return pages.mapInPandas(batches, schema)
