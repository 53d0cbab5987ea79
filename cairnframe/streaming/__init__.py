"""No streaming operators: releases of a catalogue are manual batches, so there is nothing to stream."""
