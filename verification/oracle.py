"""Independent DuckDB SQL for the registered queries."""

from __future__ import annotations

from covermonth.schemas import CLAIMS_COLUMNS, CORE_COLUMNS
from verification.inputs import CLAIMS_RAW_SQL, CORE_RAW_SQL, DATE_TEXTS_SQL, RUN_DATE

FINAL = (
    "COD_RAMO, POLIZA, CERTIFICADO, ASEGURADO, TIPO_DOC, NRO_DOCUMENTO, F_INI_COBER, "
    "F_FIN_COBERT, F_ANULACION_CERT, F_OCURRENCIA, PARENTESCO, FI, FECHA_REGISTRO, BASE"
)
CORE_RAW = CORE_RAW_SQL.format(orders="orders")
CLAIMS_RAW = CLAIMS_RAW_SQL.format(orders="orders", lineitem="lineitem")
DATE_TEXTS = DATE_TEXTS_SQL.format(orders="orders")

KEPT_COLUMNS = [c for c in CORE_COLUMNS if c not in ("ID", "RAMO", "PRODUCTO", "TIPO")]

# The patterns of the rules.
TEXT = r"'^[a-zA-ZñÑáéíóúÁÉÍÓÚ\s]+$'"
DIGITS = r"'^\d+$'"
BLANKS = "chr(9)||chr(10)||chr(13)||chr(32)||chr(160)||chr(8195)||chr(12288)"


def with_ctes(*ctes: tuple[str, str], final: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in ctes) + "\n" + final


def date_of(text: str) -> str:
    """The eight formats in order; the patterns hold DuckDB to the digit counts."""
    cut = f"substr({text}, 1, 10)"
    y4, y2, n = "[0-9]{4}", "[0-9]{2}", "[0-9]{1,2}"
    formats = [
        (f"{y4}-{n}-{n}", "%Y-%m-%d"), (f"{n}/{n}/{y4}", "%d/%m/%Y"),
        (f"{n}-{n}-{y4}", "%d-%m-%Y"), (f"{y4}/{n}/{n}", "%Y/%m/%d"),
        (f"{n}/{n}/{y2}", "%d/%m/%y"), (f"{n}-{n}-{y2}", "%d-%m-%y"),
        (f"{y2}/{n}/{n}", "%y/%m/%d"), (f"{y2}-{n}-{n}", "%y-%m-%d"),
    ]
    tries = [
        f"CASE WHEN regexp_full_match({cut}, '{pattern}') "
        f"THEN cast(try_strptime({cut}, '{form}') AS date) END"
        for pattern, form in formats
    ]
    return "coalesce(" + ", ".join(tries) + ")"


def padded(number: str, is_number: str) -> str:
    return (f"CASE WHEN length({number}) BETWEEN 5 AND 7 AND {is_number} "
            f"THEN lpad({number}, 8, '0') ELSE {number} END")


STRIPPED = "SELECT " + ", ".join(f"trim({c}, {BLANKS}) {c}" for c in KEPT_COLUMNS) + " FROM raw"

_SHIFT = f"""SELECT *, CASE
  WHEN regexp_matches(DNI_ASEGURADO, {TEXT}) AND (RUC_ASEGURADO IS NULL
    OR try_cast(RUC_ASEGURADO AS bigint) IS NOT NULL OR contains(RUC_ASEGURADO, 'CE')) THEN 1
  WHEN regexp_matches(DNI_ASEGURADO, {TEXT}) AND regexp_matches(RUC_ASEGURADO, {TEXT}) THEN 2
  ELSE 0 END sh FROM stripped"""


def _moved(name: str, one: str, two: str) -> str:
    return f"CASE sh WHEN 1 THEN {one} WHEN 2 THEN {two} ELSE {name} END {name}"


SHIFTED = "SELECT COD_RAMO, POLIZA, CERTIFICADO, " + ",\n  ".join([
    _moved("CONTRATANTE", "CONTRATANTE", "CONTRATANTE||' '||ASEGURADO"),
    _moved("ASEGURADO", "ASEGURADO||' '||DNI_ASEGURADO", "DNI_ASEGURADO||' '||RUC_ASEGURADO"),
    _moved("DNI_ASEGURADO", "RUC_ASEGURADO", "F_EMISION_POLIZA"),
    _moved("RUC_ASEGURADO", "F_EMISION_POLIZA", "F_EMISION_CERT"),
    _moved("F_EMISION_POLIZA", "F_EMISION_CERT", "F_INI_POLIZA"),
    _moved("F_EMISION_CERT", "F_INI_POLIZA", "F_FIN_POLIZA"),
    _moved("F_INI_POLIZA", "F_FIN_POLIZA", "F_ANULACION_CERT"),
    _moved("F_FIN_POLIZA", "F_ANULACION_CERT", "F_INI_COBER"),
    _moved("F_ANULACION_CERT", "F_INI_COBER", "F_FIN_COBERT"),
    _moved("F_INI_COBER", "F_FIN_COBERT", "F_ANULACION_CERT"),
    _moved("F_FIN_COBERT", "PARENTESCO", "PARENTESCO"),
    _moved("PARENTESCO", "FI", "FI"),
    _moved("FI", "NULL", "NULL"),
]) + f" FROM ({_SHIFT})"

PADDED = f"""SELECT * REPLACE (
  nullif({padded('DNI_ASEGURADO', 'try_cast(DNI_ASEGURADO AS bigint) IS NOT NULL')}, '') AS DNI_ASEGURADO,
  nullif(RUC_ASEGURADO, '') AS RUC_ASEGURADO) FROM shifted"""

# One row per rule that fires, the lowest number first.
# Which document counts, by the kind of either number and the length of the first.
DOCUMENT_RULES = """(VALUES
  ('digits', 'none', NULL, 'DNI', 'd'), ('foreign', 'none', NULL, 'DNI', 'd'),
  ('none', 'digits', NULL, 'RUC', 'r'), ('none', 'foreign', NULL, 'DNI', 'r'),
  ('digits', 'digits', 8, 'DNI', 'd'), ('digits', 'digits', 11, 'RUC', 'r')
) rules(d_kind, r_kind, d_length, TIPO_DOC, taken)"""


def _kind(number: str) -> str:
    return (f"CASE WHEN {number} IS NULL THEN 'none' WHEN regexp_matches({number}, {DIGITS}) "
            f"THEN 'digits' WHEN regexp_matches({number}, 'PAS|CE|C\\.E') THEN 'foreign' "
            f"ELSE 'other' END")


RESOLVED = f"""SELECT p.* EXCLUDE (DNI_ASEGURADO, RUC_ASEGURADO),
  CASE taken WHEN 'd' THEN DNI_ASEGURADO WHEN 'r' THEN RUC_ASEGURADO END NRO_DOCUMENTO,
  rules.TIPO_DOC
FROM padded p LEFT JOIN {DOCUMENT_RULES}
  ON d_kind = {_kind("DNI_ASEGURADO")} AND r_kind = {_kind("RUC_ASEGURADO")}
  AND coalesce(d_length = length(DNI_ASEGURADO), true)"""

GOOD = f"""SELECT * FROM resolved WHERE TIPO_DOC IN ('DNI', 'RUC')
  AND (F_INI_COBER IS NOT NULL OR F_FIN_COBERT IS NOT NULL)
  AND NOT regexp_matches(NRO_DOCUMENTO, {TEXT})"""

DATED = "SELECT * REPLACE (" + ", ".join(
    f"{date_of(c)} AS {c}" for c in ("F_INI_COBER", "F_FIN_COBERT", "F_ANULACION_CERT")
) + ") FROM good"

PLACED = """SELECT * REPLACE (CASE WHEN F_FIN_COBERT IN
  (DATE '2103-06-19', DATE '2200-02-03', DATE '4016-03-01') THEN NULL ELSE F_FIN_COBERT END
  AS F_FIN_COBERT) FROM dated"""

IN_RANGE = """SELECT * FROM placed
  WHERE F_INI_COBER BETWEEN DATE '1900-01-01' AND DATE '9000-12-31'
  AND (F_FIN_COBERT IS NULL OR F_FIN_COBERT BETWEEN DATE '1900-01-01' AND DATE '9000-12-31')
  AND (F_ANULACION_CERT IS NULL
    OR F_ANULACION_CERT BETWEEN DATE '1900-01-01' AND DATE '9000-12-31')"""


def bounded(source: str) -> str:
    entry = """CASE WHEN day(F_INI_COBER) = 1 THEN F_INI_COBER
      ELSE cast(date_trunc('month', F_INI_COBER + INTERVAL 1 MONTH) AS date) END"""
    return f"""SELECT *,
  CASE WHEN day(F_INI_COBER) = 1 OR F_FIN_COBERT = F_INI_COBER
    OR (date_diff('day', F_INI_COBER, F_FIN_COBERT) <= 30
        AND month(F_INI_COBER) >= month(F_FIN_COBERT)) THEN F_INI_COBER
    ELSE {entry} END first_day,
  CASE WHEN F_FIN_COBERT >= F_INI_COBER
    AND F_FIN_COBERT <= cast(F_INI_COBER + INTERVAL 85 YEAR AS date) THEN F_FIN_COBERT
    ELSE {entry} END last_day
FROM {source}"""


def expanded(source: str) -> str:
    return f"""SELECT *, cast(unnest(generate_series(first_day::timestamp, last_day::timestamp,
  INTERVAL 1 MONTH)) AS date) F_OCURRENCIA FROM {source}"""


CORE_CTES = [
    ("raw", CORE_RAW), ("stripped", STRIPPED), ("shifted", SHIFTED), ("padded", PADDED),
    ("resolved", RESOLVED), ("good", GOOD), ("dated", DATED), ("placed", PLACED),
    ("in_range", IN_RANGE), ("bounded", bounded("in_range")), ("expanded", expanded("bounded")),
    ("core", f"""SELECT {FINAL} FROM (SELECT *, 'CORE' BASE,
       DATE '{RUN_DATE}' FECHA_REGISTRO FROM expanded)"""),
]


def core_until(name: str, final: str) -> str:
    names = [n for n, _ in CORE_CTES]
    return with_ctes(*CORE_CTES[: names.index(name) + 1], final=final)


CLAIMS_CTES = [
    ("claims_raw", CLAIMS_RAW),
    ("claims_stripped", "SELECT " + ", ".join(
        f"trim({c}, {BLANKS}) {c}" for c in CLAIMS_COLUMNS) + " FROM claims_raw"),
    ("claims_parsed", f"""SELECT * REPLACE ({date_of('OCURRENCIA')} AS OCURRENCIA,
       trim(regexp_replace(DNI, '[^a-zA-Z0-9ñÑáéíóúÁÉÍÓÚ\\s]', '', 'g'), {BLANKS}) AS DNI)
       FROM claims_stripped"""),
    ("claims_kept", """SELECT * FROM claims_parsed
       WHERE OCURRENCIA BETWEEN DATE '1900-01-01' AND DATE '9000-12-31'
       AND OCURRENCIA NOT IN (DATE '2103-06-19', DATE '2200-02-03', DATE '4016-03-01')
       AND length(DNI) >= 3 AND length(ASEGURADO) >= 3"""),
    ("claims_clean", f"""SELECT {padded('DNI', f"regexp_matches(DNI, {DIGITS})")} NRO_DOCUMENTO,
       RAMO COD_RAMO, POLIZA, CERTIFICADO, ASEGURADO, OCURRENCIA F_INI_COBER FROM claims_kept"""),
    ("claims_full", f"""SELECT *, 'DNI' TIPO_DOC, 'SINIESTROS' BASE,
       cast(NULL AS date) F_FIN_COBERT, cast(NULL AS date) F_ANULACION_CERT,
       cast(NULL AS varchar) PARENTESCO, cast(NULL AS varchar) FI,
       DATE '{RUN_DATE}' FECHA_REGISTRO FROM claims_clean"""),
    ("claims_bounded", bounded("claims_full")),
    ("claims_expanded", expanded("claims_bounded")),
    ("claims_all", f"SELECT {FINAL} FROM claims_expanded"),
    ("claims", "SELECT DISTINCT * FROM claims_all"),
]


def claims_until(name: str, final: str) -> str:
    names = [n for n, _ in CLAIMS_CTES]
    return with_ctes(*CLAIMS_CTES[: names.index(name) + 1], final=final)


def both(final: str) -> str:
    return with_ctes(*CORE_CTES, *CLAIMS_CTES, final=final)


BOTH = f"SELECT {FINAL} FROM core UNION ALL SELECT {FINAL} FROM claims"
