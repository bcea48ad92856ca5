"""Star-schema ELT on Spark: landed JSON -> staging -> dimensions -> fact."""
