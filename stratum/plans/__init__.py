"""Table-driven plans: feeds over the driver tables, Silver/Gold specs, reports."""
