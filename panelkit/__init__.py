"""panelkit: panel-data analytics as Spark DataFrame jobs."""

from panelkit.spec import PanelSpec

__all__ = ["PanelSpec"]
