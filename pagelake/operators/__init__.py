from . import bronze, gold, silver, views

__all__ = ["bronze", "gold", "silver", "views"]
