"""Image byte rules as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from broadleaf import fixed as V


def _hex(data: Column, at: int, n: int) -> Column:
    """Bytes at..at+n (from 0) in hexadecimal."""
    return F.hex(F.substring(data, at + 1, n))


def _little(data: Column, at: int | Column, n: int) -> Column:
    """Unsigned little-endian integer of n bytes."""
    out = F.lit(0).cast("long")
    for k in range(n):
        byte = F.hex(data.substr((F.lit(at) if isinstance(at, int) else at) + 1 + k, F.lit(1)))
        out = out + F.conv(byte, 16, 10).cast("long") * (1 << 8 * k)
    return out


def webp_size(data: Column) -> Column:
    """Struct of width and height; null if the header is malformed."""
    kind = _hex(data, 12, 4)
    at = F.instr(F.substring(F.hex(data), 41, 40), "9D012A")  # odd places are whole bytes
    frame = F.lit(20) + ((at - 1) / 2).cast("int")
    bits = _little(data, 21, 4)
    w = F.when(kind == "56503858", 1 + _little(data, 24, 3)).when((kind == "56503820") & (at > 0) & (at % 2 == 1), _little(data, frame + 3, 2).bitwiseAND(0x3FFF)).when((kind == "5650384C") & (_hex(data, 20, 1) == "2F"), bits.bitwiseAND(0x3FFF) + 1)
    h = F.when(kind == "56503858", 1 + _little(data, 27, 3)).when((kind == "56503820") & (at > 0) & (at % 2 == 1), _little(data, frame + 5, 2).bitwiseAND(0x3FFF)).when((kind == "5650384C") & (_hex(data, 20, 1) == "2F"), F.shiftright(bits, 14).bitwiseAND(0x3FFF) + 1)
    size = F.octet_length(data)
    ok = (size >= 30) & (_hex(data, 0, 4) == "52494646") & (_hex(data, 8, 4) == "57454250") & (_little(data, 4, 4) + 8 == size) & w.isNotNull()
    return F.when(ok, F.struct(w.alias("width"), h.alias("height")))


def image_error(data: Column, media_type: Column, max_bytes: int) -> Column:
    """The first rule an image breaks; null if none."""
    size = webp_size(data)
    low, high = V.IMAGE_SIDES
    return (
        F.when(F.coalesce(F.octet_length(data), F.lit(0)) == 0, "image_empty")
        .when(F.octet_length(data) > max_bytes, "image_too_large")
        .when(F.lower(media_type) != "image/webp", "image_media_type_invalid")
        .when(size.isNull(), "image_webp_malformed")
        .when(~(size["width"].between(low, high) & size["height"].between(low, high)), "image_dimensions_unreasonable")
        .when(F.abs(size["width"] / size["height"] - V.ASPECT) / V.ASPECT > V.ASPECT_TOLERANCE, "image_aspect_ratio_invalid")
    )


def raster_type(data: Column) -> Column:
    """Media type by the first bytes; null if unknown."""
    return F.when(_hex(data, 0, 8) == "89504E470D0A1A0A", "image/png").when(_hex(data, 0, 3) == "FFD8FF", "image/jpeg").when((F.octet_length(data) >= 12) & (_hex(data, 0, 4) == "52494646") & (_hex(data, 8, 4) == "57454250"), "image/webp")


def decoded_image(value: Column, media_type: Column) -> Column:
    """Struct of data, media and error, from base64 text or a data URL."""
    is_url = value.startswith("data:")
    inside = F.lower(F.regexp_extract(value, r"(?s)^data:([^;,]+);base64,(.+)$", 1))
    raw = F.when(is_url, F.regexp_extract(value, r"(?s)^data:([^;,]+);base64,(.+)$", 2)).otherwise(value)
    strict = raw.rlike(r"^(?:[A-Za-z0-9+/]{4})*(?:[A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?$")
    error = F.when(is_url & (inside == ""), "image_data_url_invalid").when(is_url & media_type.isNotNull() & (inside != F.lower(media_type)), "image_media_type_mismatch").when(~strict, "image_base64_invalid")
    return F.struct(F.when(error.isNull(), F.try_to_binary(raw, F.lit("base64"))).alias("data"), F.when(error.isNull(), F.when(is_url, inside).otherwise(F.lower(media_type))).alias("media"), error.alias("error"))
