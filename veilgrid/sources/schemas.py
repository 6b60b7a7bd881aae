"""Schemas of the records that the stages exchange."""

from __future__ import annotations

BOXES = "array<array<int>>"
SEGMENTATION = f"name string, original_size array<int>, sam3_inference_time double, sam_boxes {BOXES}, mask_relpath string"
POSTPROCESS = f"name string, original_size array<int>, sam3_inference_time double, erosion_diffusion_time double, alarm struct<triggered:boolean,motivation:string>, bounding_boxes {BOXES}, cut_size array<int>, rotation_angle double, crop_relpath string"
DETACHED = POSTPROCESS + ", mask_relpath string, source_image_relpath string"
DEIDENTIFICATION = f"name string, deidentification_time double, boxes {BOXES}"
REPORT = (
    f"name string, alarm struct<triggered:boolean,motivation:string>, bounding_boxes {BOXES}, deidentification_boxes {BOXES}, "
    "metrics struct<times:struct<sam3_inference:double,erosion_diffusion:double,deidentification:double>,original_size:array<int>,cut_size:array<int>,rotation_angle:double>"
)
VLM = f"name string, boxes {BOXES}, texts array<string>, vlm_time double, error string"
DECISIONS = "timestamp_utc timestamp, relpath string, status string"
FAILURES = "mask string, error string"
LABELS = "boxes array<array<double>>, scores array<double>, prompt string, image_file string"
GROUND_TRUTH = "map<string, struct<shapes:array<struct<label:string,points:array<array<double>>,shape_type:string>>>>"
LEGACY = "map<string, array<struct<bbox:array<array<int>>,boxes:array<array<int>>,text:string,confidence:double>>>"
IMAGE = "name string, path string, height int, width int, channels int, data binary"
EMPTY_REPLY = '{"detections":[]}'
REPLY = "struct<detections:array<struct<text:string,bbox:array<double>>>>"
