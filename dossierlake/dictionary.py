"""Attribute dictionary: which codes are single-valued and which multi-valued."""

from __future__ import annotations

import json
from collections.abc import Iterable
from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SINGLE = "single"
MULTI = "multi"

# Attribute codes of the tagged files and of generated data.
SINGLE_CODES = "B010001,B010011,B010012,B010013,B010014,B010015,B010026,B010027"
MULTI_CODES = "B010007,B022001,B022002,B022003"


def split_codes(text: str) -> list[str]:
    """Comma separated codes, trimmed, blanks and repeats dropped."""
    return list(dict.fromkeys(c for c in (p.strip() for p in text.split(",")) if c))


class AttrDictionary:
    def __init__(self, single: Iterable[str], multi: Iterable[str]):
        kinds = {code: SINGLE for code in single}
        kinds.update({code: MULTI for code in multi})
        self.kinds = kinds

    @classmethod
    def from_text(cls, single: str, multi: str) -> AttrDictionary:
        return cls(split_codes(single), split_codes(multi))

    @classmethod
    def default(cls) -> AttrDictionary:
        return cls.from_text(SINGLE_CODES, MULTI_CODES)

    @classmethod
    def from_descriptor(cls, path: str) -> AttrDictionary:
        """Read a dataset descriptor: JSON ``{"columns": [{"code", "store"}, ...]}``."""
        with open(path, encoding="utf-8") as handle:
            columns = json.load(handle)["columns"]
        return cls(
            [c["code"] for c in columns if c.get("store") == SINGLE],
            [c["code"] for c in columns if c.get("store") == MULTI],
        )

    def codes(self, kind: str) -> list[str]:
        return [code for code, k in self.kinds.items() if k == kind]

    def kind(self, code: Column) -> Column:
        """``single``, ``multi`` or null for an unknown code."""
        if not self.kinds:
            return F.lit(None).cast("string")
        pairs = F.create_map(*[F.lit(x) for x in chain.from_iterable(self.kinds.items())])
        return F.try_element_at(pairs, code)

    def is_kind(self, code: Column, kind: str) -> Column:
        codes = self.codes(kind)
        return F.coalesce(code.isin(codes), F.lit(False)) if codes else F.lit(False)

    def fold_kind(self, code: Column) -> Column:
        """Kind used by the profile fold: unknown codes count as single."""
        return F.when(self.is_kind(code, MULTI), F.lit(MULTI)).otherwise(F.lit(SINGLE))

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.kinds.items()), "code string, kind string")

    def join_kind(self, attrs: DataFrame) -> DataFrame:
        """Left lookup of the kind of every attribute row.

        A dictionary is configuration that the driver holds: it is a literal of the plan, here
        as everywhere else.
        """
        return attrs.withColumn("kind", self.kind(F.col("code")))
