"""Fixed schemas and fixed values of the policy and claims extracts."""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

# These must equal the ones used by the extracts' producers
# and by the dashboard that reads the result.

CORE_COLUMNS = [
    "ID", "COD_RAMO", "RAMO", "PRODUCTO", "POLIZA", "CERTIFICADO", "TIPO",
    "CONTRATANTE", "ASEGURADO", "DNI_ASEGURADO", "RUC_ASEGURADO",
    "F_EMISION_POLIZA", "F_EMISION_CERT", "F_INI_POLIZA", "F_FIN_POLIZA",
    "F_ANULACION_CERT", "F_INI_COBER", "F_FIN_COBERT", "PARENTESCO", "FI",
]
CORE_UNUSED_COLUMNS = ["ID", "RAMO", "PRODUCTO", "TIPO"]
CORE_OPTIONAL_COLUMNS = ["PARENTESCO", "FI"]
CORE_DATE_COLUMNS = ["F_ANULACION_CERT", "F_INI_COBER", "F_FIN_COBERT"]

SHIFTABLE_COLUMNS = [
    "CONTRATANTE", "ASEGURADO", "DNI_ASEGURADO", "RUC_ASEGURADO",
    "F_EMISION_POLIZA", "F_EMISION_CERT", "F_INI_POLIZA", "F_FIN_POLIZA",
    "F_ANULACION_CERT", "F_INI_COBER", "F_FIN_COBERT", "PARENTESCO", "FI",
]

CLAIMS_COLUMNS = ["DNI", "RAMO", "POLIZA", "CERTIFICADO", "ASEGURADO", "OCURRENCIA"]

CONSOLIDATED_COLUMNS = [
    "COD_RAMO", "POLIZA", "CERTIFICADO", "ASEGURADO", "TIPO_DOC",
    "NRO_DOCUMENTO", "F_INI_COBER", "F_FIN_COBERT", "F_ANULACION_CERT",
    "F_OCURRENCIA", "PARENTESCO", "FI", "FECHA_REGISTRO", "BASE",
]
REPROCESSED_COLUMNS = [
    "COD_RAMO", "POLIZA", "CERTIFICADO", "ASEGURADO", "TIPO_DOC",
    "NRO_DOCUMENTO", "ULT_DIGI_DOC", "F_INI_COBER", "F_FIN_COBERT",
    "F_ANULACION_CERT", "F_OCURRENCIA", "PARENTESCO", "FI", "FECHA_REGISTRO",
    "BASE",
]

BASE_CORE = "CORE"
BASE_CLAIMS = "SINIESTROS"

PLACEHOLDER_END_DATES = ["2103-06-19", "2200-02-03", "4016-03-01"]
MIN_VALID_DATE = "1900-01-01"
MAX_VALID_DATE = "9000-12-31"
MAX_COVER_YEARS = 85

TEXT_ONLY_PATTERN = r"^[a-zA-ZñÑáéíóúÁÉÍÓÚ\s]+$"
DOCUMENT_NOISE_PATTERN = r"[^a-zA-Z0-9ñÑáéíóúÁÉÍÓÚ\s]"
ALL_DIGITS_PATTERN = r"^\d+$"
FOREIGN_DOCUMENT_MARKS = ["PAS", "CE", "C.E"]
PADDED_DOCUMENT_LENGTHS = [5, 6, 7]
DOCUMENT_LENGTH = 8
TAX_ID_LENGTH = 11
MIN_CLAIM_TEXT_LENGTH = 3

CSV_DELIMITERS = [",", ";", "\t", "|"]
FILE_ROWS_REPORT = 20_000_000
ROW_GROUP_ROWS_REPORT = 1_000_000
ROW_GROUP_ROWS_SORTED = 120_000


def all_strings(columns: list[str]) -> StructType:
    """Schema in which every column is a nullable string."""
    return StructType([StructField(name, StringType(), True) for name in columns])


CORE_SCHEMA = all_strings(CORE_COLUMNS)
CLAIMS_SCHEMA = all_strings(CLAIMS_COLUMNS)
