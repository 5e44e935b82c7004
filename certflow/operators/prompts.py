"""Prompts rendered from certificate facts, and facts read back from text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The Norwegian prompt, filled with certificate facts in this order.
PROMPT_PARTS = [
    ("Opptre som ekspert i et selskap som lever av å selge informasjon om eiendom og bygninger. "
     "Du skal oppsummere relevante forhold knyttet til energimerke fra Enova med Energikarakter ", "energikarakter"),
    (" og Oppvarmingskarakter ", "oppvarmingskarakter"),
    (" for boligen. Merkenummer er '", "merkenummer"),
    ("' datert ", "utstedelsesdato"),
    (". Hold deg til fakta og ikke gå ut over 500 ord. Byggeår er ", "byggear"),
    (" og bygningskategori er ", "bygningskategori"),
    (". Attesten dekker ", "enheter"),
    (" registrerte enheter. Energiattesten er innmeldt av ", "innmelder"),
    (". Innmeldt adresse ", "adresse"),
    (". Bruksareal ", "bruksareal"),
    (" kvadratmeter. Beregnet Levert Energi Totalt kWh/m2: ", "kwh_m2"),
    (". Beregnet Levert Energi Totalt kWh: ", "kwh"),
    (". Beregnet Fossilandel er ", "fossilandel"),
]
PROMPT_END = (
    "%. {text}\n\nSvaret skal være på dette formatet: \nEiendom: Litt om eiendommen \n"
    "Positive ting: Hva er bra i forhold til Energiattesten \n"
    "Kort vurdering: Spesielle forhold som bør trekkes frem av en eller annen art."
)


def render_prompt(facts: dict[str, Column], text: Column) -> Column:
    """The prompt of one certificate; a missing fact reads 'ukjent'."""
    pieces: list[Column] = []
    for lead, name in PROMPT_PARTS:
        pieces += [F.lit(lead), F.coalesce(facts[name].cast("string"), F.lit("ukjent"))]
    before, after = PROMPT_END.split("{text}")
    pieces += [F.lit(before), F.coalesce(text, F.lit("")), F.lit(after)]
    return F.concat(*pieces)


def extract_facts(text: Column) -> list[Column]:
    """Rating, heating grade, certificate number, year and energy use named in a text.

    The source system only names this step; the rules here are ours: the first
    mention counts, and a fact that is not mentioned is null.
    """
    def found(pattern: str) -> Column:
        return F.nullif(F.regexp_extract(text, f"(?iu){pattern}", 1), F.lit(""))

    return [
        F.upper(found(r"energikarakter\s+([A-G])(?![\p{L}\p{N}])")).alias("rating"),
        found(r"oppvarmingskarakter\s+(\p{L}+)").alias("heating"),
        found(r"(energiattest-[0-9]{4}-[0-9]+)").alias("certificate"),
        found(r"byggeår\s+(?:er\s+)?([0-9]{4})").cast("int").alias("built"),
        found(r"kWh/m2:?\s*([0-9]+(?:\.[0-9]+)?)").cast("double").alias("kwh_m2"),
    ]
