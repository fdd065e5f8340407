"""Security-master files: one fixed-width line per security, legacy code page.

Lines are split on the raw bytes by the ordinary text scan, so a large file is
read by many tasks; only then is each line decoded.  (No trail byte of the code
page is a line break.)  The tail of a line has a fixed width in characters and
the name before it has not, so fields are counted from the end.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---- Fixed values: code page, head positions, fields of the tail in file order.
CODE_PAGE = "cp949"
JAVA_CODE_PAGE = "x-windows-949"
HEAD_WIDTHS = (9, 12)

MAIN_MARKET_HEAD = ("단축코드", "표준코드", "한글명")
MAIN_MARKET = (
    ("그룹코드", 2), ("시가총액규모", 1), ("지수업종대분류", 4), ("지수업종중분류", 4), ("지수업종소분류", 4), ("제조업", 1), ("저유동성", 1),
    ("지배구조지수종목", 1), ("KOSPI200섹터업종", 1), ("KOSPI100", 1), ("KOSPI50", 1), ("KRX", 1), ("ETP", 1),
    ("ELW발행", 1), ("KRX100", 1), ("KRX자동차", 1), ("KRX반도체", 1), ("KRX바이오", 1), ("KRX은행", 1), ("SPAC", 1),
    ("KRX에너지화학", 1), ("KRX철강", 1), ("단기과열", 1), ("KRX미디어통신", 1), ("KRX건설", 1), ("Non1", 1), ("KRX증권", 1),
    ("KRX선박", 1), ("KRX섹터_보험", 1), ("KRX섹터_운송", 1), ("SRI", 1), ("기준가", 9), ("매매수량단위", 5), ("시간외수량단위", 5),
    ("거래정지", 1), ("정리매매", 1), ("관리종목", 1), ("시장경고", 2), ("경고예고", 1), ("불성실공시", 1), ("우회상장", 1), ("락구분", 2),
    ("액면변경", 2), ("증자구분", 2), ("증거금비율", 3), ("신용가능", 1), ("신용기간", 3), ("전일거래량", 12), ("액면가", 12), ("상장일자", 8),
    ("상장주수", 15), ("자본금", 21), ("결산월", 2), ("공모가", 7), ("우선주", 1), ("공매도과열", 1), ("이상급등", 1), ("KRX300", 1),
    ("KOSPI", 1), ("매출액", 9), ("영업이익", 9), ("경상이익", 9), ("당기순이익", 5), ("ROE", 9), ("기준년월", 8), ("시가총액", 9),
    ("그룹사코드", 3), ("회사신용한도초과", 1), ("담보대출가능", 1), ("대주가능", 1),
)

SECOND_MARKET_HEAD = ("단축코드", "표준코드", "한글종목명")
SECOND_MARKET = (
    ("증권그룹구분코드", 2), ("시가총액 규모 구분 코드 유가", 1), ("지수업종 대분류 코드", 4), ("지수 업종 중분류 코드", 4), ("지수업종 소분류 코드", 4),
    ("벤처기업 여부 (Y/N)", 1), ("저유동성종목 여부", 1), ("KRX 종목 여부", 1), ("ETP 상품구분코드", 1), ("KRX100 종목 여부 (Y/N)", 1),
    ("KRX 자동차 여부", 1), ("KRX 반도체 여부", 1), ("KRX 바이오 여부", 1), ("KRX 은행 여부", 1), ("기업인수목적회사여부", 1),
    ("KRX 에너지 화학 여부", 1), ("KRX 철강 여부", 1), ("단기과열종목구분코드", 1), ("KRX 미디어 통신 여부", 1), ("KRX 건설 여부", 1),
    ("(코스닥)투자주의환기종목여부", 1), ("KRX 증권 구분", 1), ("KRX 선박 구분", 1), ("KRX섹터지수 보험여부", 1), ("KRX섹터지수 운송여부", 1),
    ("KOSDAQ150지수여부 (Y,N)", 1), ("주식 기준가", 9), ("정규 시장 매매 수량 단위", 5), ("시간외 시장 매매 수량 단위", 5), ("거래정지 여부", 1),
    ("정리매매 여부", 1), ("관리 종목 여부", 1), ("시장 경고 구분 코드", 2), ("시장 경고위험 예고 여부", 1), ("불성실 공시 여부", 1),
    ("우회 상장 여부", 1), ("락구분 코드", 2), ("액면가 변경 구분 코드", 2), ("증자 구분 코드", 2), ("증거금 비율", 3), ("신용주문 가능 여부", 1),
    ("신용기간", 3), ("전일 거래량", 12), ("주식 액면가", 12), ("주식 상장 일자", 8), ("상장 주수(천)", 15), ("자본금", 21), ("결산 월", 2),
    ("공모 가격", 7), ("우선주 구분 코드", 1), ("공매도과열종목여부", 1), ("이상급등종목여부", 1), ("KRX300 종목 여부 (Y/N)", 1), ("매출액", 9),
    ("영업이익", 9), ("경상이익", 9), ("단기순이익", 5), ("ROE(자기자본이익률)", 9), ("기준년월", 8), ("전일기준 시가총액 (억)", 9),
    ("그룹사 코드", 3), ("회사신용한도초과여부", 1), ("담보대출가능여부", 1), ("대주가능여부", 1),
)
# ---- End of fixed values.


Layout = Sequence[tuple[str, int]]


def _decoder(code_page: str):
    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"line": [raw.decode(code_page) for raw in batch["raw"]]})

    return decode


def decoded_lines(spark: SparkSession, path: str, code_page: str = CODE_PAGE) -> DataFrame:
    """Text lines of a file in a code page Spark's readers refuse: ``(line)``.

    The JVM decodes them where ``spark.sql.legacy.javaCharsets`` lets it; Python
    workers do elsewhere.
    """
    raw = spark.read.text(path).select(F.col("value").cast("binary").alias("raw"))
    if code_page == CODE_PAGE and spark.conf.get("spark.sql.legacy.javaCharsets", "false") == "true":
        return raw.select(F.decode("raw", JAVA_CODE_PAGE).alias("line"))
    return raw.mapInPandas(_decoder(code_page), "line string")


def fixed_width(lines: DataFrame, head: tuple[str, str, str], layout: Layout) -> tuple[DataFrame, DataFrame]:
    """``(rows, errors)``: the trimmed fields of each line, and the lines too short to have them.

    Blank lines are neither.  Everything stays text: codes and dates keep their
    leading zeros.
    """
    tail = sum(width for _, width in layout)
    short, standard = HEAD_WIDTHS
    line = F.col("line")
    tail_start = F.length(line) - tail
    name_start = short + standard
    columns = [
        F.rtrim(F.substring(line, 1, short)).alias(head[0]),
        F.rtrim(F.substring(line, short + 1, standard)).alias(head[1]),
        F.trim(line.substr(F.lit(name_start + 1), tail_start - name_start)).alias(head[2]),
    ]
    offset = 1
    for name, width in layout:
        columns.append(F.trim(line.substr(tail_start + offset, F.lit(width))).alias(name))
        offset += width
    written = lines.where(F.trim("line") != "")
    whole = F.length(line) >= name_start + tail
    reason = F.concat(F.lit("line of "), F.length(line).cast("string"), F.lit(f" characters, {name_start + tail} or more expected"))
    return written.where(whole).select(*columns), written.where(~whole).select("line", reason.alias("error"))


def read_main_market(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return fixed_width(decoded_lines(spark, path), MAIN_MARKET_HEAD, MAIN_MARKET)


def read_second_market(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return fixed_width(decoded_lines(spark, path), SECOND_MARKET_HEAD, SECOND_MARKET)
