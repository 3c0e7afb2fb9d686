"""Fields of a dataset's JSON-LD descriptor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossaria.functions.text import url_fragment
from glossaria.schemas import DESCRIPTOR


def parse(text: Column) -> Column:
    return F.from_json(text, DESCRIPTOR)


def table_extent(doc: Column, kind: str) -> Column:
    """The declared rows of the last table whose type names ``kind``; 0 without one. A table without a type is passed over."""
    fits = F.filter(doc["tables"], lambda t: F.coalesce(t["dc:conformsTo"].contains(kind), F.lit(False)))
    return F.coalesce(F.try_element_at(fits, F.lit(-1))["dc:extent"], F.lit(0)).cast("long")


def last_titled(items: Column, title: str, field: str) -> Column:
    """``field`` of the last item with this title; null without one."""
    same = lambda i: F.coalesce(i["dc:title"] == title, F.lit(False))
    return F.try_element_at(F.filter(items, same), F.lit(-1))[field]


def described(descriptors: DataFrame) -> DataFrame:
    """``Dataset`` and ``value`` (the text) with ``doc``, the fields, parsed once for all that is made of them."""
    return descriptors.withColumn("doc", parse(F.col("value"))).drop("value")


def metadata_columns(has_cognates: Column) -> list[Column]:
    """The columns of a metadata record beside ``Dataset``; missing fields are empty."""
    d = F.col("doc")
    told = lambda name: F.coalesce(d[name], F.lit(""))
    kinds = {"Form_Count": "FormTable", "Language_Count": "LanguageTable", "Parameter_Count": "ParameterTable"}
    return [
        told("dc:title").alias("Title"), told("dc:bibliographicCitation").alias("Citation"), told("dcat:accessURL").alias("URL"), told("dc:license").alias("License"),
        url_fragment(told("dc:conformsTo")).alias("CLDF_Module"),
        last_titled(d["prov:wasDerivedFrom"], "Repository", "dc:created").alias("Repository_Version"),
        last_titled(d["prov:wasGeneratedBy"], "python", "dc:description").alias("Python_Version"),
        *(table_extent(d, kind).alias(c) for c, kind in kinds.items()), has_cognates.alias("Has_Cognates"),
    ]


def reference_columns() -> list[Column]:
    """Versions of the reference systems that a dataset was made with; null where it names none."""
    items = F.col("doc")["prov:wasDerivedFrom"]
    return [last_titled(items, s, "dc:created").alias(f"{s}_Version") for s in ("Glottolog", "Concepticon", "CLTS")]


def metadata(parsed: DataFrame, has_cognates: Column) -> DataFrame:
    """The metadata record of each dataset of :func:`described`."""
    return parsed.select("Dataset", *metadata_columns(has_cognates))


def references(parsed: DataFrame) -> DataFrame:
    """The reference versions of each dataset of :func:`described`."""
    return parsed.select("Dataset", *reference_columns())
