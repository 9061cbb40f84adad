"""Reading panels, link tables and event files; writing events, labels and reports."""
