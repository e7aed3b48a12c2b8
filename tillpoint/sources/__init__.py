"""Sources: driver tables, sales sheets (CSV / workbook), reference tables,
queue messages and receipt pages."""
