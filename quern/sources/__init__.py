"""Tables, files and queues."""
