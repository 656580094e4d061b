"""Explicit schemas (DDL) of the engine's tables; open model output is kept as JSON text beside them."""

from __future__ import annotations

CANDIDATES = (
    "candidate_id string, paper_id string, year int, month string, source_bucket string, figure_index int, image_kind string, "
    "image_path string, json_path string, caption_latex string, reference_paragraphs_latex array<string>, labels array<string>, "
    "figure_tex string, status string, source_effective_ext string, was_converted_to_png boolean, merged_panel_count int, "
    "merged_source_image_count int, merge_layout string, is_eval_paper boolean"
)
QUESTIONS = (
    "id string, candidate_id string, image string, question string, task_type string, answer_type string, difficulty string, "
    "requires_exact_reading boolean, requires_caption_context boolean, reasoning_steps_required int, "
    "visual_elements_required array<string>, risk_notes array<string>"
)
CAPTIONS = ("caption_id string, candidate_id string, dense_caption string, caption_thinking string, uncertainty array<string>, caption_verified boolean, schema_version string")
FAILURES = ("id string, candidate_id string, task_type string, error string")
EVAL_RECORDS = ("split string, figure_id int, paper_id string, chart_types array<string>, title string, caption string, category string, year string, figure_path string")
EVENTS = ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")
