"""Relational model of the register: table types, keys and rules, and the jobs that use them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import partial, reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terravane.functions.bind import quoted
from terravane.operators.quality import broken_rules, listed, mark_repeated
from terravane.sources.files import read_table, write_table

# --- fixed values: tables, columns, types and NOT NULL of the published model --------------
# (names as published, "geomtrie" included)
TABLES: dict[str, str] = {
    "domeinwaarden_gebruiksdoel": """
        waarde string NOT NULL,
        omschrijving string NOT NULL""",
    "pand": """
        identificatie string NOT NULL,
        geomtrie string NOT NULL,
        oorspronkelijk_bouwjaar string NOT NULL,
        status string NOT NULL,
        geconstateerd string NOT NULL,
        documentdatum date NOT NULL,
        documentnummer date""",
    "woonplaats": """
        identificatie string NOT NULL,
        naam string NOT NULL,
        geometrie string NOT NULL,
        status string NOT NULL,
        geconstateerd string NOT NULL,
        documentdatum date NOT NULL,
        documentnummer string NOT NULL""",
    "openbare_ruimte": """
        identificatie string NOT NULL,
        naam string NOT NULL,
        type string NOT NULL,
        status string NOT NULL,
        geconstateerd string NOT NULL,
        documentdatum date NOT NULL,
        documentnummer string NOT NULL,
        woonplaats_identificatie string""",
    "nummeraanduiding": """
        identificatie string NOT NULL,
        huisnummer string NOT NULL,
        huisletter string NOT NULL,
        huisnummertoevoeging string NOT NULL,
        postcode string NOT NULL,
        type_adresseerbaar_object string NOT NULL,
        status string NOT NULL,
        geconstateerd string NOT NULL,
        documentdatum date NOT NULL,
        documentnummer string NOT NULL,
        woonplaats_identificatie string NOT NULL,
        openbare_ruimte_identificatie string""",
    "standplaats": """
        identificatie string NOT NULL,
        status string NOT NULL,
        geometrie string NOT NULL,
        geconstateerd string NOT NULL,
        documentdatum string NOT NULL,
        documentnummer string NOT NULL,
        hoofdadres string,
        nevenadres string""",
    "verblijfsobject": """
        identificatie string NOT NULL,
        geometrie string NOT NULL,
        gebruiksdoel string,
        oppervlakte bigint NOT NULL,
        status string NOT NULL,
        geconstateerd string NOT NULL,
        documentdatum string NOT NULL,
        documentnummer string NOT NULL,
        hoofdadres string,
        nevenadres string,
        pand_identificatie string NOT NULL""",
    "woz_object": """
        woz_objectnummer string,
        woz_object_geometrie string,
        soort_objectcode string,
        datum_begin_geldigheid_woz_objectgegevens date,
        datum_einde_geldigheid_woz_objectgegevens date,
        to_do_meer_toevoegen date,
        nummeraanduiding string""",
    "woz_waarde": """
        woz_objectnummer string,
        gerelateerd_woz_object date,
        vastgestelde_waarde string,
        waardepeildatum date,
        toestandpeildatum date,
        heffingsmaatstaf_ozb date,
        heffingsmaatstaf_ozb_gebruikers date,
        datum_begin_geldigheid_waardegegevens date,
        datum_einde_geldigheid_waardegegevens date,
        aanduiding_waardegegevens_in_onderzoek bigint,
        tijdstip_registratie_waardegegevens timestamp_ntz,
        ingangsdatum_waarde date""",
    # the bridge joins text keys, so its columns are text
    "domeinwaarden_gebruiksdoel_verblijfsobject": """
        verblijfsobject_ID string,
        domeinwaarden_gebruiksdoel_ID string""",
    "ligplaats": """
        identificatie string NOT NULL,
        status string NOT NULL,
        geometrie string NOT NULL,
        geconstateerd string NOT NULL,
        documentdatum string NOT NULL,
        documentnummer string NOT NULL,
        hoofdadres string,
        nevenadres string""",
}


class ForeignKey(NamedTuple):
    table: str
    column: str
    parent: str
    parent_column: str = "identificatie"


# --- fixed values: keys and rules of the published model -----------------------------------
UNIQUE_KEYS = {
    "domeinwaarden_gebruiksdoel": "waarde",
    "ligplaats": "identificatie",
    "nummeraanduiding": "identificatie",
    "openbare_ruimte": "identificatie",
    "pand": "identificatie",
    "standplaats": "identificatie",
    "verblijfsobject": "identificatie",
    "woonplaats": "identificatie",
    "woz_object": "woz_objectnummer",
}
FOREIGN_KEYS = [
    ForeignKey("ligplaats", "hoofdadres", "nummeraanduiding"),
    ForeignKey("ligplaats", "nevenadres", "nummeraanduiding"),
    ForeignKey("nummeraanduiding", "woonplaats_identificatie", "woonplaats"),
    ForeignKey("nummeraanduiding", "openbare_ruimte_identificatie", "openbare_ruimte"),
    ForeignKey("openbare_ruimte", "woonplaats_identificatie", "woonplaats"),
    ForeignKey("standplaats", "hoofdadres", "nummeraanduiding"),
    ForeignKey("standplaats", "nevenadres", "nummeraanduiding"),
    ForeignKey("verblijfsobject", "hoofdadres", "nummeraanduiding"),
    ForeignKey("verblijfsobject", "nevenadres", "nummeraanduiding"),
    ForeignKey("verblijfsobject", "gebruiksdoel", "domeinwaarden_gebruiksdoel", "waarde"),
    ForeignKey("verblijfsobject", "pand_identificatie", "pand"),
    ForeignKey("woz_object", "nummeraanduiding", "nummeraanduiding"),
    ForeignKey("woz_waarde", "woz_objectnummer", "woz_object", "woz_objectnummer"),
]
DOMAINS = {("woonplaats", "status"): ["Woonplaats aangewezen", "Woonplaats ingetrokken"]}
# char and varchar columns only
MAX_LENGTHS = {
    "nummeraanduiding": {
        "huisnummer": 80,
        "type_adresseerbaar_object": 40,
        "documentnummer": 40,
        "woonplaats_identificatie": 4,
        "openbare_ruimte_identificatie": 80,
    },
    "openbare_ruimte": {
        "identificatie": 80,
        "naam": 80,
        "documentnummer": 40,
        "woonplaats_identificatie": 4,
    },
    "woonplaats": {"identificatie": 4, "naam": 80, "status": 30, "documentnummer": 40},
}
# column whose values are a separated list, checked value by value through its bridge table
MANY_TO_MANY = ("verblijfsobject", "gebruiksdoel")


TYPES = {
    "string": T.StringType(),
    "date": T.DateType(),
    "bigint": T.LongType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def table_schema(table: str) -> T.StructType:
    fields = []
    for line in TABLES[table].split(","):
        name, kind, *required = line.split()
        fields.append(T.StructField(name, TYPES[kind], nullable=not required))
    return T.StructType(fields)


def required_columns(table: str) -> list[str]:
    return [f.name for f in table_schema(table).fields if not f.nullable]


def conform(df: DataFrame, table: str, mapping: Mapping[str, str | Column]) -> DataFrame:
    """The columns of a model table in order and type; a value that does not cast is null.

    ``mapping`` gives a source column or expression per model column; unmapped columns are
    null. Whether required columns are filled is a question for :func:`model_report`.
    """
    schema = table_schema(table)
    unknown = set(mapping) - set(schema.names)
    if unknown:
        raise ValueError(f"{table} has no column {sorted(unknown)}")

    def source(name: str) -> Column:
        value = mapping.get(name)
        if value is None:
            return F.lit(None)
        return F.col(value) if isinstance(value, str) else value

    return df.select(
        *[source(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def row_rules(table: str) -> list[tuple[str, str, str]]:
    """(rule, column, SQL condition of a breaking row) for rules that need only the row."""
    rules = [("not_null", c, f"{quoted(c)} IS NULL") for c in required_columns(table)]
    for column, limit in MAX_LENGTHS.get(table, {}).items():
        rules.append(("max_length", column, f"length({quoted(column)}) > {limit}"))
    for (name, column), allowed in DOMAINS.items():
        if name == table:
            values = ", ".join(f"'{value}'" for value in allowed)
            rules.append(("domain", column, f"{quoted(column)} NOT IN ({values})"))
    return rules


def checked(df: DataFrame, table: str) -> DataFrame:
    """``df`` with ``broken``, the rules of the model that a row breaks by itself or by its key."""
    marked = df.withColumn("broken", broken_rules(row_rules(table)))
    return mark_repeated(marked, UNIQUE_KEYS[table], "broken") if table in UNIQUE_KEYS else marked


def write_checked(df: DataFrame, table: str, folder: str) -> None:
    """Write a model table with the rows that break a rule apart from the others, in one pass."""
    apart = checked(df, table).withColumn("quarantined", (F.size("broken") > 0).cast("string"))
    write_table(apart, folder, "quarantined")


def sound_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of :func:`write_checked` that keep all rules."""
    return read_table(spark, folder).where("quarantined = 'false'").drop("quarantined", "broken")


def quarantined_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The rows that do not, one for each ``rule`` and ``column_name`` they break."""
    rows = read_table(spark, folder).where("quarantined = 'true'").drop("quarantined")
    return rows.select(*[c for c in rows.columns if c != "broken"], F.inline("broken"))


FINDING = ["table_name", "rule", "column_name", "n_violations"]
#: Scope of the row rules of a table, see :class:`Rule`.
ROWS = "rows of "


class Rule(NamedTuple):
    """A declared rule and where it is counted.

    Row rules are counted under a scope of their table. Keys and references are counted by value
    under the table that holds the key: slot 0 is the key, the others refer to it.
    """

    scope: str
    slot: int
    table_name: str
    rule: str
    column_name: str


def declared_rules(tables: Iterable[str]) -> list[Rule]:
    """Every rule whose tables are all given."""
    given = set(tables)
    found = [
        Rule(ROWS + name, slot, name, rule, column)
        for name in sorted(given)
        for slot, (rule, column, _) in enumerate(row_rules(name))
    ]
    for parent in sorted(given & set(UNIQUE_KEYS)):
        found.append(Rule(parent, 0, parent, "unique", UNIQUE_KEYS[parent]))
        references = [k for k in FOREIGN_KEYS if k.parent == parent and k.table in given]
        found += [Rule(parent, slot, k.table, "foreign_key", k.column) for slot, k in enumerate(references, 1)]
    return found


def _named(rule: Rule, value: Column) -> Column:
    return F.struct(F.lit(rule.scope).alias("scope"), F.lit(rule.slot).alias("slot"), value.alias("value"))


def _counted_values(df: DataFrame, table: str, rules: Sequence[Rule]) -> DataFrame:
    """``scope, slot, value`` for every key, reference and broken rule of a table, in one pass.

    A generator over a fixed list of cells, nulls where nothing is to be counted, is generated
    code; lambdas, which are not, are left to the one column that holds lists.
    """
    conditions = [condition for _, _, condition in row_rules(table)]
    cells, lists = [], []
    for rule in rules:
        place, own = f"'scope', '{rule.scope}', 'slot', {rule.slot}, 'value'", quoted(rule.column_name)
        if rule.scope.startswith(ROWS):
            cells.append(f"if({conditions[rule.slot]}, named_struct({place}, ''), NULL)")
        elif rule.rule == "foreign_key" and (table, rule.column_name) == MANY_TO_MANY:
            lists.append(F.transform(listed(df, rule.column_name), partial(_named, rule)))
        else:
            cells.append(f"if({own} IS NOT NULL, named_struct({place}, string({own})), NULL)")
    found = F.expr(f"array({', '.join(cells)})")
    none = F.array().cast("array<struct<scope: string, slot: int, value: string>>")
    found = F.concat(found, *[F.coalesce(values, none) for values in lists]) if lists else found
    return df.select(F.inline(found)).where("scope IS NOT NULL")


def model_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name, rule, column_name, n_violations`` for every declared rule.

    Rules whose tables are not all given are left out (at least one table is). Counts are of rows that break a rule. Every
    table is read once. What it holds of keys and references is counted by value before it is
    shuffled, all of it in one exchange, in which the references to a value meet its key.
    """
    rules = declared_rules(tables)
    spark = next(iter(tables.values())).sparkSession
    if not rules:
        return spark.createDataFrame([], "table_name string, rule string, column_name string, n_violations long")
    spread = [_counted_values(df, t, own) for t, df in tables.items() if (own := [r for r in rules if r.table_name == t])]
    slots = range(1 + max(r.slot for r in rules))
    counts = [F.count_if(F.col("slot") == i).alias(f"n{i}") for i in slots]
    met = reduce(DataFrame.union, spread).groupBy("scope", "value").agg(*counts)
    known, several = F.col("n0") > 0, F.col("n0") > 1
    broken = [F.col("scope").startswith(ROWS) | (~known if i else several) for i in slots]
    totals = met.groupBy("scope").agg(*[F.sum(F.when(b, F.col(f"n{i}"))).alias(f"n{i}") for i, b in enumerate(broken)])
    cells = F.array(*[F.struct(F.lit(i).alias("slot"), F.col(f"n{i}").alias("n")) for i in slots])
    listing = spark.createDataFrame(rules, "scope string, slot int, table_name string, rule string, column_name string")
    report = listing.join(totals.select("scope", F.inline(cells)), ["scope", "slot"], "left")
    return report.withColumn("n_violations", F.coalesce("n", F.lit(0))).select(*FINDING)
