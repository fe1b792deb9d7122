"""Sources: driver test tables as the application's inputs, topic streams,
serving tables and the user dimension."""
