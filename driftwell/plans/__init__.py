"""What is decided on the driver: table descriptors, schema changes, routing, settings."""
