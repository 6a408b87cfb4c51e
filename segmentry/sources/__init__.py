"""Tables in and out: schemas, fixed values, bindings and sinks."""
