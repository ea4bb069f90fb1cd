"""Schemas of the tables between stages, in the order in which their fields are written."""

from __future__ import annotations

MANIFEST = "sid string, doc_id string, txt_rel string, txt_abs string, src_kind string, src_rel string, src_exists boolean, uid string, size_bytes bigint, rel_path_stg1 string, authors string, title string, year string, udc string, bbk string"
PAGES = (
    "chunk_id string, sid string, doc_id string, uid string, topic string, txt_sha1 string, txt_rel string, txt_abs string, src_kind string, src_rel string, src_exists boolean, page_start int, page_end int, text string, rel_path_stg1 string, authors string, title string, year string, udc string, bbk string, size_bytes_txt bigint, "
    "manifest_generator_program string, manifest_generator_version string, manifest_schema_version string, chunk_generator_program string, chunk_generator_version string"
)
LINE = "line_no int, text string, text_len int, text_len_stripped int, token_count_simple int, letter_ratio double, digit_ratio double, punct_ratio double, space_ratio double, single_char_token_ratio double, avg_token_len double, has_letter boolean, has_digit boolean, is_duplicate_in_chunk boolean, table_like_score_line int, line_class string"
METRICS = "text_len int, line_count int, token_count int, letter_ratio double, digit_ratio double, punct_ratio double, single_char_token_ratio double, non_letter_line_ratio double, avg_token_len double, short_line_ratio double, duplicate_line_ratio double, junk_score int, quality_class string"
ANALYSED = f"{PAGES}, doc_id16 string, {METRICS}, lines array<struct<{', '.join(x.replace(' ', ':', 1) for x in LINE.split(', '))}>>"
CLEANED = f"{ANALYSED}, clean_mode string, text_before_clean_len int, text_after_clean_len int, chunk_changed boolean, became_empty_after_clean boolean"
CHUNKS = "chunk_id string, doc_id string, text string, page_start int, year string, txt_rel string"
LINE_FIELDS = [x.split(" ")[0] for x in LINE.split(", ")]


def names(schema: str) -> list[str]:
    return [x.split(" ")[0] for x in schema.split("array<")[0].rstrip(", ").split(", ")]
