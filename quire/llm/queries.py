"""The queries of this subpackage, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quire.llm.abuse import p9_found, p9_rates, p9_scores
from quire.llm.canonical import p4_classes, p4_found, p4_text
from quire.llm.mixing import p8_counts, p8_shares
from quire.llm.repeats import p1_found, p1_text
from quire.llm.residue import p2_found
from quire.llm.scans import p5_found, p5_text
from quire.llm.splitting import p3_found, p3_pieces
from quire.llm.tokens import p7_ids
from quire.llm.truncation import p6_found, p6_rates

_ALL = [p1_found, p1_text, p2_found, p3_found, p3_pieces, p4_classes, p4_found, p4_text, p5_found, p5_text, p6_found, p6_rates, p7_ids, p8_counts, p8_shares, p9_found, p9_rates, p9_scores]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _ALL}
