"""Tables of a wordlist corpus and their columns."""

from __future__ import annotations

from pyspark.sql import types as T

# The columns of the published tables, in order.
FORMS_WORKING = (
    "ID", "Dataset", "Local_ID", "Language_ID", "Parameter_ID", "Value", "Form", "Segments", "Comment", "Source", "Loan", "Graphemes", "Profile",
    "Cognacy", "Doubt", "Cognate_Detection_Method", "Cognate_Source", "Alignment", "Glottocode", "Glottolog_Name", "Concepticon_ID", "Concepticon_Gloss",
    "Morpheme_Index", "Segment_Slice",
)
FORMS_WRITTEN = (
    "ID", "Dataset", "Language_ID", "Glottocode", "Glottolog_Name", "Parameter_ID", "Concepticon_Gloss", "Value", "Form", "Segments", "Cognacy", "Alignment",
    "Loan", "Morpheme_Index", "Segment_Slice", "Doubt", "Comment", "Source", "Cognate_Detection_Method", "Cognate_Source",
)
LANGUAGES = ("ID", "Dataset", "Name", "Glottocode", "Glottolog_Name", "ISO639P3code", "Macroarea", "Latitude", "Longitude", "Family", "Location", "Remark")
PARAMETERS = ("ID", "Dataset", "Name", "Concepticon_ID", "Concepticon_Gloss")
METADATA = ("Dataset", "Title", "Citation", "URL", "License", "CLDF_Module", "Repository_Version", "Python_Version", "Form_Count", "Language_Count", "Parameter_Count", "Has_Cognates")
REFERENCES = ("Dataset", "Glottolog_Version", "Concepticon_Version", "CLTS_Version")

#: Optional columns of a judgment file that a form takes over, and the name that each gets.
JUDGMENT_COLUMNS = ("Alignment", "Doubt", "Cognate_Detection_Method", "Source", "Morpheme_Index", "Segment_Slice")
JUDGMENT_NAMES = {"Source": "Cognate_Source"}

#: Files of a dataset: those without which it is left out, and those that it may lack.
REQUIRED_FILES = ("cldf-metadata.json", "forms.csv", "languages.csv", "parameters.csv")
OPTIONAL_FILES = ("cognates.csv", "sources.bib")
RELEASE_FILES = ("forms.csv", "languages.csv", "parameters.csv", "metadata.csv", "sources.bib", "validation_report.json")
#: Columns without which a file, and with it its dataset, is left out.
REQUIRED_COLUMNS = {"forms.csv": ("ID", "Language_ID", "Parameter_ID"), "languages.csv": ("ID",), "parameters.csv": ("ID",), "cognates.csv": ("Form_ID", "Cognateset_ID")}

BOOLEANS, NUMBERS = {"Loan", "Doubt"}, {"Latitude", "Longitude"}
COUNTS = {"Form_Count", "Language_Count", "Parameter_Count"}

DESCRIPTOR = (
    "struct<`dc:title`:string,`dc:bibliographicCitation`:string,`dcat:accessURL`:string,`dc:license`:string,`dc:conformsTo`:string,"
    "tables:array<struct<`dc:conformsTo`:string,`dc:extent`:bigint>>,"
    "`prov:wasDerivedFrom`:array<struct<`dc:title`:string,`dc:created`:string>>,"
    "`prov:wasGeneratedBy`:array<struct<`dc:title`:string,`dc:description`:string>>>"
)

REPORT = (
    "summary struct<total_datasets:bigint,total_forms:bigint,total_languages:bigint,total_parameters:bigint,datasets_with_cognates:bigint,datasets_with_partial_cognacy:bigint,forms_with_multiple_cognatesets:bigint>,"
    "data_quality struct<glottocode_coverage_percent:double,concepticon_coverage_percent:double,forms_with_cognate_data_percent:double,forms_with_segments_percent:double,forms_with_alignment_percent:double>,"
    "partial_cognacy struct<datasets_with_morpheme_index:array<string>,datasets_with_segment_slice:array<string>,forms_with_morpheme_index:bigint,forms_with_segment_slice:bigint>,"
    "completeness map<string,struct<forms:bigint,languages:bigint,parameters:bigint,has_cognates:boolean,Segments_null_pct:double,Comment_null_pct:double,Loan_null_pct:double,Cognacy_null_pct:double,Alignment_null_pct:double,columns_present:array<string>,columns_absent:array<string>,"
    "empty_vs_missing:map<string,struct<filled:bigint,empty_string:bigint,missing_na:bigint>>>>,"
    "referential_integrity struct<orphan_language_ids:bigint,orphan_parameter_ids:bigint,forms_without_glottocode:bigint,forms_without_concepticon_id:bigint,invalid_bibtex_references:bigint>,"
    "row_multiplication struct<forms_with_multiple_alignments:bigint,total_duplicate_ids_from_cognates:bigint>,"
    "version_distribution map<string,map<string,bigint>>"
)


def kind_of(column: str) -> T.DataType:
    if column in BOOLEANS or column == "Has_Cognates":
        return T.BooleanType()
    if column in NUMBERS:
        return T.DoubleType()
    return T.LongType() if column in COUNTS else T.StringType()


def schema_of(columns: tuple[str, ...]) -> T.StructType:
    return T.StructType([T.StructField(c, kind_of(c)) for c in columns])
