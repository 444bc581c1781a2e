"""Declared schemas and fixed reference values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


COMPLAINTS = _schema(
    ("ticket_id", T.StringType()),
    ("type", T.StringType()),
    ("organization", T.StringType()),
    ("comment", T.StringType()),
    ("photo", T.StringType()),
    ("photo_after", T.StringType()),
    ("address", T.StringType()),
    ("district", T.StringType()),
    ("province", T.StringType()),
    ("timestamp", T.StringType()),
    ("state", T.StringType()),
    ("star", T.StringType()),
)
LABELED_COMPLAINTS = T.StructType(
    COMPLAINTS.fields
    + _schema(("llm_label", T.StringType()), ("llm_reasoning", T.StringType())).fields
)
HOSPITALS = _schema(
    ("ลำดับ", T.IntegerType()),
    ("ชื่อสถานพยาบาล (Thai)", T.StringType()),
    ("Hospital Name (English)", T.StringType()),
    ("หมายเลขโทรศัพท์ (Telephone)", T.StringType()),
)
FIRE_STATIONS = _schema(
    ("ชื่อ", T.StringType()),
    ("หมายเลขโทรศัพท์", T.StringType()),
    ("โทรสาร", T.StringType()),
)
FIRE_INCIDENTS = _schema(
    ("_id", T.LongType()),
    ("Province", T.StringType()),
    ("District", T.StringType()),
)
POPULATION = _schema(
    ("DISTRICT", T.StringType()),
    ("TOTAL", T.LongType()),
    ("MALE", T.LongType()),
    ("FEMALE", T.LongType()),
)

# Answer codes, their texts, and which of them are worth another try.
LABEL_TEXT = {
    "0": "Not Sufficient",
    "1": "Sufficient",
    "2": "Uncertain (has partial evidence)",
    "253": "Missing in JSON Response",
    "254": "Invalid Label from LLM",
    "255": "API Error",
}
UNKNOWN_LABEL = "Unknown"
VALID_CODES = ("0", "1", "2")
RETRY_LABELS = ("Missing in JSON Response", "Invalid Label from LLM", "API Error")
KNOWN_LABELS = tuple(LABEL_TEXT.values()) + (UNKNOWN_LABEL,)

# Weight of a label in the severity score.
SEVERITY_WEIGHTS = {
    "Not Sufficient": 3.0,
    "API Error": 2.5,
    "Uncertain (has partial evidence)": 1.5,
    "Sufficient": 0.5,
}

# Upper ends of the bins, as shares of the largest value.
QUARTER_BINS = (0.25, 0.5, 0.75)
FIFTH_BINS = (0.2, 0.4, 0.6, 0.8)

# Fixed value: the province the dashboard reports on.
HOME_PROVINCE = "กรุงเทพมหานคร"

# The 50 districts, Thai and English name.
DISTRICTS = (
    ("พระนคร", "Phra Nakhon"),
    ("ดุสิต", "Dusit"),
    ("หนองจอก", "Nong Chok"),
    ("บางรัก", "Bang Rak"),
    ("บางเขน", "Bang Khen"),
    ("บางกะปิ", "Bang Kapi"),
    ("ปทุมวัน", "Pathum Wan"),
    ("ป้อมปราบศัตรูพ่าย", "Pom Prap Sattru Phai"),
    ("พระโขนง", "Phra Khanong"),
    ("มีนบุรี", "Min Buri"),
    ("ลาดกระบัง", "Lat Krabang"),
    ("ยานนาวา", "Yan Nawa"),
    ("สัมพันธวงศ์", "Samphanthawong"),
    ("พญาไท", "Phaya Thai"),
    ("ธนบุรี", "Thon Buri"),
    ("บางกอกใหญ่", "Bangkok Yai"),
    ("ห้วยขวาง", "Huai Khwang"),
    ("คลองสาน", "Khlong San"),
    ("ตลิ่งชัน", "Taling Chan"),
    ("บางกอกน้อย", "Bangkok Noi"),
    ("บางขุนเทียน", "Bang Khun Thian"),
    ("ภาษีเจริญ", "Phasi Charoen"),
    ("หนองแขม", "Nong Khaem"),
    ("ราษฎร์บูรณะ", "Rat Burana"),
    ("บางพลัด", "Bang Phlat"),
    ("ดินแดง", "Din Daeng"),
    ("บึงกุ่ม", "Bueng Kum"),
    ("สาทร", "Sathon"),
    ("บางซื่อ", "Bang Sue"),
    ("จตุจักร", "Chatuchak"),
    ("บางคอแหลม", "Bang Kho Laem"),
    ("ประเวศ", "Prawet"),
    ("คลองเตย", "Khlong Toei"),
    ("สวนหลวง", "Suan Luang"),
    ("จอมทอง", "Chom Thong"),
    ("ดอนเมือง", "Don Mueang"),
    ("ราชเทวี", "Ratchathewi"),
    ("ลาดพร้าว", "Lat Phrao"),
    ("วัฒนา", "Watthana"),
    ("บางแค", "Bang Khae"),
    ("หลักสี่", "Lak Si"),
    ("สายไหม", "Sai Mai"),
    ("คันนายาว", "Khan Na Yao"),
    ("สะพานสูง", "Saphan Sung"),
    ("วังทองหลาง", "Wang Thonglang"),
    ("คลองสามวา", "Khlong Sam Wa"),
    ("บางนา", "Bang Na"),
    ("ทวีวัฒนา", "Thawi Watthana"),
    ("ทุ่งครุ", "Thung Khru"),
    ("บางบอน", "Bang Bon"),
)


def district_dimension(spark: SparkSession) -> DataFrame:
    """The 50 districts as rows ``(amp_th, amp_en)``."""
    return spark.createDataFrame(list(DISTRICTS), "amp_th string, amp_en string")
