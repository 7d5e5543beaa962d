"""Analytics over nested, schema-typed records on Spark: flattening, parsing, provenance walks, validation and inventories."""
