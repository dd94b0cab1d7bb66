"""Jobs that chain the operators: capture cycle, assurance, drain, readiness."""

from tidemark.plans.capture import Capture, MetadataError
from tidemark.plans.readiness import Trial, assess

__all__ = ["Capture", "MetadataError", "Trial", "assess"]
