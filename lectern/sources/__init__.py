"""Tables, files and sinks."""
