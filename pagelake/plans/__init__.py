from .medallion import MedallionResult, run_medallion

__all__ = ["MedallionResult", "run_medallion"]
