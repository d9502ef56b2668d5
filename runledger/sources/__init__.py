"""Tables, feeds and folders that operators read from and write to."""
