"""Tidemark: incremental change capture and layered tables on Spark DataFrames."""

from tidemark.spec import CaptureSpec, ObjectSpec, ReferentialRule, SpecError

__all__ = ["CaptureSpec", "ObjectSpec", "ReferentialRule", "SpecError"]
