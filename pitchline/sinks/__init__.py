"""pitchline.sinks"""
