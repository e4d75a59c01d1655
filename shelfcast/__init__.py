"""Retail demand and replenishment analytics as Spark DataFrame jobs."""

from shelfcast.config import PlanningConfig

__all__ = ["PlanningConfig"]
