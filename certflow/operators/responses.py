"""Landed certificate responses to flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from certflow.functions.scalars import certificate_number
from certflow.operators.conform import to_number
from certflow.operators.outcomes import call_outcome
from certflow.schemas import RESPONSE_SCHEMA

# Stored column -> field of the response object.
RESPONSE_FIELDS = {
    "attestnummer": "energiattest.attestnummer",
    "merkenummer": None,
    "bruksareal": "enhet.bruksareal",
    "energikarakter": "energiattest.energikarakter",
    "oppvarmingskarakter": "energiattest.oppvarmingskarakter",
    "attest_url": "energiattest.attestUrl",
    "matrikkel_kommunenummer": "enhet.matrikkel.kommunenummer",
    "matrikkel_gardsnummer": "enhet.matrikkel.`gårdsnummer`",
    "matrikkel_bruksnummer": "enhet.matrikkel.bruksnummer",
    "matrikkel_festenummer": "enhet.matrikkel.festenummer",
    "matrikkel_seksjonsnummer": "enhet.matrikkel.seksjonsnummer",
    "matrikkel_andelsnummer": "enhet.matrikkel.andelsnummer",
    "matrikkel_bruksenhetsnummer": "enhet.matrikkel.bruksenhetsnummer",
    "bygg_bygningsnummer": "enhet.bygg.bygningsnummer",
    "bygg_byggear": "enhet.bygg.`byggeår`",
    "bygg_kategori": "enhet.bygg.kategori",
    "bygg_type": "enhet.bygg.type",
    "utstedelsesdato": "energiattest.utstedelsesdato",
    "adresse_gatenavn": "enhet.adresse.gatenavn",
    "adresse_postnummer": "enhet.adresse.postnummer",
    "adresse_poststed": "enhet.adresse.poststed",
    "registering_RegisteringType": "energiattest.registering.type",
    "registering_BeregnetLevertEnergiTotaltkWhm2": "energiattest.registering.beregnetLevertEnergiTotaltkWhm2",
    "registering_BeregnetLevertEnergiTotaltkWh": "energiattest.registering.beregnetLevertEnergiTotaltkWh",
    "registering_HarEnergivurdering": "energiattest.registering.harEnergivurdering",
    "registering_Energivurderingdato": "energiattest.registering.energivurderingdato",
    "registering_BeregnetFossilandel": "energiattest.registering.beregnetFossilandel",
    "registering_Materialvalg": "energiattest.registering.materialvalg",
    "OrganisasjonsNummer": "organisasjonsnummer",
}
NUMBERS = [
    "bruksareal", "registering_BeregnetLevertEnergiTotaltkWhm2", "registering_BeregnetLevertEnergiTotaltkWh",
    "registering_BeregnetFossilandel",
]
PARAMETERS = {
    "paramKommunenummer": "kommunenummer",
    "paramGardsnummer": "gardsnummer",
    "paramBruksnummer": "bruksnummer",
    "paramSeksjonsnummer": "seksjonsnummer",
    "paramBruksenhetnummer": "bruksenhetnummer",
    "paramBygningsnummer": "bygningsnummer",
}


def parse_bodies(responses: DataFrame) -> DataFrame:
    """Add `certificates`, the parsed array, and `returned`, the length of the body.

    Both are null for a failed call or broken JSON. A body that is one object has no array; its
    length is the number of its keys. Null elements of an array stay null. A body is parsed once: only an
    array that does not fit the schema is read again for its length.
    """
    ok = F.col("http_status") == 200
    begins = lambda mark: ok & F.col("body").rlike(rf"\A\s*{mark}")
    rows = responses.withColumn("certificates", F.when(begins(r"\["), F.from_json("body", RESPONSE_SCHEMA)))
    length = F.coalesce(F.array_size("certificates"), F.json_array_length("body"))
    return rows.withColumn("returned", F.when(begins(r"\["), length).when(begins(r"\{"), F.array_size(F.json_object_keys("body"))))


def flatten(parsed: DataFrame, batch_time: Column) -> DataFrame:
    """One row of 38 columns per certificate object; nothing is shuffled.

    A null sub-object gives null columns and the row stays; a null object gives none. Values keep
    their text whatever their JSON type; the four numbers are cast, and what can't be is
    null here and listed by `untyped_values`. Booleans are stored as 'True' and 'False'.
    """
    # an inner explode makes Spark infer filters on the array, which parses the body again
    rows = parsed.withColumn("c", F.explode_outer("certificates")).filter(F.col("c").isNotNull())
    out = [batch_time.alias("ImportDate"), F.col("CertificateID")]
    out += [F.col(p).alias(name) for name, p in PARAMETERS.items()]
    for name, field in RESPONSE_FIELDS.items():
        if name == "merkenummer":
            c = certificate_number(F.col("c.energiattest.attestUrl"))
        else:
            c = F.col(f"c.{field}")
        if name in NUMBERS:
            c = to_number(c)
        elif name == "registering_HarEnergivurdering":
            c = F.initcap(F.lower(c))
        out.append(c.alias(name))
    return rows.select(*out, batch_time.alias("Created"))


def untyped_values(parsed: DataFrame) -> DataFrame:
    """Numbers of the objects that are no numbers: CertificateID, object (from 0), column and text."""
    objects = parsed.select("CertificateID", F.posexplode("certificates").alias("object", "c"))
    fields = F.array(*[F.struct(F.lit(n).alias("column"), F.col(f"c.{RESPONSE_FIELDS[n]}").alias("text")) for n in NUMBERS])
    rows = objects.select("CertificateID", "object", F.inline(fields))
    return rows.where(F.col("text").isNotNull() & to_number(F.col("text")).isNull())


def known_paths(kind: T.DataType, at: str = "") -> dict[str, bool]:
    """Paths of the fields of nested structs, and whether each is an object."""
    found: dict[str, bool] = {}
    if isinstance(kind, T.ArrayType):
        return known_paths(kind.elementType, at)
    for field in kind.fields if isinstance(kind, T.StructType) else []:
        path = f"{at}.{field.name}" if at else field.name
        found |= {path: isinstance(field.dataType, T.StructType), **known_paths(field.dataType, path)}
    return found


def unknown_fields(responses: DataFrame) -> DataFrame:
    """Fields of the objects that the schema does not know: CertificateID, object (from 0), path and value (as JSON).

    The body is parsed once, as a variant, which keeps every field. Known objects are opened level by level; an
    unknown one is given as a whole. Bodies that are no array, and elements that are no objects, have no fields.
    """
    known = known_paths(T.DataType.fromDDL(RESPONSE_SCHEMA))
    depth = 1 + max(p.count(".") for p in known)
    names = F.array(*[F.lit(p) for p in known])
    objects = F.array(F.lit(""), *[F.lit(p) for p, is_object in known.items() if is_object])
    elements = F.try_variant_get(F.try_parse_json("body"), "$", "array<variant>")
    rows = responses.where("http_status = 200").select("CertificateID", F.posexplode(elements).alias("object", "value"))
    rows = rows.withColumn("path", F.lit(""))
    for _ in range(depth):
        fields = F.map_entries(F.try_variant_get("value", "$", "map<string, variant>"))
        below = lambda e: F.struct(F.concat_ws(".", F.nullif("path", F.lit("")), e["key"]).alias("path"), e["value"].alias("value"))
        itself = F.array(F.struct("path", "value"))
        opened = F.when(F.array_contains(objects, F.col("path")), F.transform(fields, below)).otherwise(itself)
        rows = rows.select("CertificateID", "object", F.inline(opened))
        rows = rows.where(F.array_contains(objects, F.col("path")) | ~F.array_contains(names, F.col("path")))
    unknown = rows.where(~F.array_contains(names, F.col("path")))
    return unknown.select("CertificateID", "object", "path", F.to_json("value").alias("value"))


def call_outcomes(parsed: DataFrame) -> DataFrame:
    """P14 per call: what the body returned, and its objects, each of which is a stored row."""
    n = F.coalesce("returned", F.lit(0))
    saved = F.coalesce(F.size(F.filter("certificates", lambda c: c.isNotNull())), F.lit(0))
    error = F.col("error") if "error" in parsed.columns else F.lit(None).cast("string")
    return parsed.select(
        "CertificateID", *call_outcome(F.col("http_status"), F.col("body"), n, saved, error)
    )
