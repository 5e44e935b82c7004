"""Column lists and types of the tables that pass between the stages."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {"string": T.StringType(), "long": T.LongType(), "int": T.IntegerType(), "timestamp": T.TimestampType()}


def _struct(text: str) -> T.StructType:
    """A schema from 'name type, ...' that needs no running session."""
    pairs = [part.split() for part in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Columns of the yearly certificate files, by kind of value.
NUMERIC_COLUMNS = [
    "Knr", "Gnr", "Bnr", "Snr", "Fnr", "Andelsnummer", "Bygningsnummer",
    "Postnummer", "Organisasjonsnummer", "Byggear",
]
DATETIME_COLUMNS = ["Utstedelsesdato", "EnergiVurderingDato"]
STRING_COLUMNS = [
    "GateAdresse", "Poststed", "BruksEnhetsNummer", "Bygningskategori", "Energikarakter",
    "Oppvarmingskarakter", "TypeRegistrering", "Attestnummer",
    "BeregnetLevertEnergiTotaltkWhm2", "BeregnetFossilandel", "Materialvalg", "HarEnergiVurdering",
]
CERTIFICATE_COLUMNS = NUMERIC_COLUMNS + DATETIME_COLUMNS + STRING_COLUMNS
CERTIFICATE_KEY = "Attestnummer"

IMPORTED = T.StructType(
    [T.StructField(c, T.DoubleType()) for c in NUMERIC_COLUMNS]
    + [T.StructField(c, T.TimestampType()) for c in DATETIME_COLUMNS]
    + [T.StructField(c, T.StringType()) for c in STRING_COLUMNS]
)

QUARANTINE = _struct(
    "source_path string, source_block long, source_row long, year int, reason string, record string"
)

# Shape of one object of a certificate response. Leaves are text, so a value of any JSON type is kept.
_RESPONSE_OBJECT = """struct<
  organisasjonsnummer: string,
  energiattest: struct<attestnummer: string, attestUrl: string, energikarakter: string,
    oppvarmingskarakter: string, utstedelsesdato: string,
    registering: struct<type: string, beregnetLevertEnergiTotaltkWhm2: string,
      beregnetLevertEnergiTotaltkWh: string, harEnergivurdering: string,
      energivurderingdato: string, beregnetFossilandel: string, materialvalg: string>>,
  enhet: struct<bruksareal: string,
    adresse: struct<gatenavn: string, postnummer: string, poststed: string>,
    matrikkel: struct<kommunenummer: string, `gårdsnummer`: string, bruksnummer: string,
      festenummer: string, seksjonsnummer: string, andelsnummer: string, bruksenhetsnummer: string>,
    bygg: struct<bygningsnummer: string, `byggeår`: string, kategori: string, type: string>>>"""
RESPONSE_SCHEMA = f"array<{_RESPONSE_OBJECT}>"

# Call parameters of a certificate request, and the log around them.
CALL_COLUMNS = [
    "CertificateID", "kommunenummer", "gardsnummer", "bruksnummer", "seksjonsnummer",
    "bruksenhetnummer", "bygningsnummer", "Attestnummer",
]
API_LOG = T.StructType(
    [T.StructField("CertificateID", T.LongType()), T.StructField("LogDate", T.TimestampType())]
    + [T.StructField(c, T.StringType()) for c in CALL_COLUMNS[1:]]
    + [
        T.StructField("records_returned", T.LongType()),
        T.StructField("status_message", T.StringType()),
        T.StructField("Created", T.TimestampType()),
    ]
)
DOWNLOAD_LOG = _struct(
    "attest_url string, filename string, download_date timestamp, status string, "
    "status_message string, file_size long, http_status_code int, created timestamp"
)
FILE_INVENTORY = _struct(
    "file_id string, filename string, full_path string, file_size long, "
    "file_extension string, sync_date timestamp"
)
FILE_EXTRACT = _struct(
    "file_id string, filename string, extracted_text string, extraction_date timestamp, "
    "extraction_method string, extraction_status string, character_count long, page_count int"
)
CLEANED_TEXT = _struct(
    "file_id string, clean_text string, cleaned_date timestamp, character_count long"
)
CLEANING_SKETCH = _struct("outcome string, sign int, place long, n long")
ANSWERS = _struct(
    "openAIAnswerID string, file_id string, PromptVersion string, AboutEstate string, "
    "Positives string, Evaluation string, Created timestamp"
)
